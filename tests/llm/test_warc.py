import gzip
import hashlib
import io
import json
import random
import zlib

import pytest

from paceline.llm import warc as A

SCHEMA = "page_id long, url string, html string, no long, h long, archive string"


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, 2, "x") for i, u, h in rows], SCHEMA)


def brute(rows):
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    out, done = [], set()
    for i, p in payloads:
        ids = [j for j, q in payloads if q == p and j is not None]
        keep = max(ids, default=None)
        first = len(p) < 1000 or (i == keep and (keep, p) not in done)
        if first:
            done.add((i, p))
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "response" if first else "revisit", None if first else keep))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def made():
    rnd = random.Random(2)
    text = lambda n: "".join(rnd.choice("abcé <>\n") for _ in range(n))
    rows = [(i, f"http://x.example/{i}?q=ä b\r\nX: y", text(rnd.choice([0, 10, 990, 1500, 4000]))) for i in range(120)]
    hot = text(1200)
    rows += [(200 + k, None, hot) for k in range(60)] + [(300 + k, "u", rows[k][2]) for k in range(20)]
    return rows + [(400, "u", None), (401, "u", ""), (None, "u", hot), (None, "u", "z" * 1000), (None, "u", "z" * 1000), (500, "u", "y" * 1000),
                   (500, "u", "y" * 1000), (500, "u", "y" * 1000), (None, None, "v" * 2000), (501, "u", "w" * 999), (502, "u", "w" * 999), (503, "u", "long " * 400_000)]


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:
        # Everything passes the bit table, archives and chunks are tiny.
        monkeypatch.setattr(A, "sifted", lambda values, bits: values == values)
        monkeypatch.setattr(A, "ARCHIVE_BYTES", 5000)
        monkeypatch.setattr(A, "CHUNK", 7)
    rows = made()[: 240 if small else None]
    rows = [r for r in rows if not small or len(r[2] or "") < 10_000]
    out = A.archived_pages(table(spark, rows), with_payload=True)
    assert got(out) == brute(rows)
    texts = {(i, (h or "").encode()) for i, _, h in rows}
    found = out.where("record_type = 'response'").collect()
    assert all((r.page_id, bytes(r.payload)) in texts for r in found) and out.where("record_type = 'revisit' AND payload IS NOT NULL").isEmpty()


def test_empty_table(spark):
    out = A.archived_pages(table(spark, []))
    assert out.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] and out.collect() == []


def stream(cuts):
    """Records as a gzip file whose members end at ``cuts``, wherever that is."""
    records = [A.page_record(i, f"http://e/{i}", p, len(p), hashlib.sha1(p).hexdigest(), i, None) for i, p in enumerate([b"", b"a\r\n\r\nWARC/1.1\r\n", b"x" * 5000])]
    raw = b"".join(records)
    edges = [0, *cuts, len(raw)]
    return records, b"".join(gzip.compress(raw[a:b]) for a, b in zip(edges, edges[1:]))


@pytest.mark.parametrize("cuts", [[], [10], [300, 301, 2000]])
@pytest.mark.parametrize("chunk", [1, 50, 1 << 18])
def test_normaliser_gives_each_record_its_member(cuts, chunk, monkeypatch):
    monkeypatch.setattr(A, "CHUNK", chunk)
    records, raw = stream(cuts)
    archive, sidecar = io.BytesIO(), io.BytesIO()
    assert A.normalise(io.BytesIO(raw), archive, sidecar) == 3
    entries = [json.loads(x) for x in sidecar.getvalue().splitlines()]
    assert [zlib.decompress(archive.getvalue()[e["offset"] : e["offset"] + e["length"]], 31) for e in entries] == records
    assert sum(e["length"] for e in entries) == len(archive.getvalue()) and [e["uri"] for e in entries] == [f"http://e/{i}" for i in range(3)]
    again, beside = io.BytesIO(), io.BytesIO()
    archive.seek(0)
    A.normalise(archive, again, beside)
    assert again.getvalue() == archive.getvalue() and beside.getvalue() == sidecar.getvalue()
    assert A.member(archive, entries[2]["offset"], entries[2]["length"])[1].endswith(b"x" * 5000)


def test_normaliser_refuses_broken_archives():
    _, raw = stream([])
    for bad in (raw[:-30], gzip.compress(gzip.decompress(raw)[:-1000]), gzip.compress(b"no record\r\n")):
        with pytest.raises(ValueError):
            A.normalise(io.BytesIO(bad), io.BytesIO(), io.BytesIO())
    assert A.normalise(io.BytesIO(b""), io.BytesIO(), io.BytesIO()) == 0
