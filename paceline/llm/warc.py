"""WARC archives: written as single gzip streams, normalised to one gzip member per record, read by offset.

Crawlers and converters often compress a whole archive as one gzip stream, which can only be read from
its start. The normaliser inflates such a stream once, chunk by chunk, follows the record headers, and
writes every record as a gzip member of its own, with a sidecar of offsets beside the archive; from then
on a record is one seek and one small inflation. Input of several members, in any cut, is taken too.

Payloads that came before are not stored again: of equal payloads one is a response, the others are
revisit records that refer to it. Payloads do not travel for that. A bit table of fixed size tells
which may have a copy; all others go straight from the scan into the archive of their task.

Archives lie in the shared folder under names of their own; only those that a finished task reports,
in a written table, are ever read, so a lost executor leaves no half archive behind in the result.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from typing import Any, BinaryIO
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from paceline.llm import words as W
from paceline.llm.decontamination import sieve, sifted
from paceline.session import scratch_path, staged

#: Shortest payload that a revisit record may stand for.
LEAST_REVISIT = 1000
#: Bytes of records after which a task begins a new archive, and bytes inflated or read at a time.
ARCHIVE_BYTES, CHUNK = 256 << 20, 1 << 18
_LEVEL = 6
#: Fixed values of the format.
_VERSION = b"WARC/1.1"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP = 31
_DATE = "2024-01-01T00:00:00Z"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


# --- records -------------------------------------------------------------------------------------


def _record(fields: list[tuple[str, Any]], block: bytes) -> bytes:
    head = [_VERSION, *[f"{k}: {v}".encode() for k, v in fields if v is not None], b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def record_name(page_id: int | None, digest: str, copy: int | None = None) -> str:
    """The id of a record; the response that others refer to has none but its page and payload in it."""
    text = f"{'' if page_id is None else page_id}/{digest}" + ("" if copy is None else f"/{copy}")
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, text)}>"


def page_record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, copy: int | None, refers_to: tuple[int | None] | None) -> bytes:
    """A response with its payload, or a revisit (``payload`` None) that names the page it refers to."""
    head = _HTTP.format(size).encode()
    revisit = refers_to is not None
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_name(page_id, digest, copy)), ("WARC-Date", _DATE),
        ("WARC-Target-URI", None if url is None else quote(url, safe="%/:=&?~#+!$,;'@()*[]")), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", _REVISIT_PROFILE if revisit else None), ("WARC-Refers-To", record_name(refers_to[0], digest) if revisit else None),
        ("Page-Id", page_id), ("Refers-To-Page-Id", refers_to[0] if revisit else None), ("Content-Type", "application/http; msgtype=response")]
    return _record(fields, head if revisit else head + payload)


class Inflated:
    """The bytes of a gzip stream of any number of members, inflated once and piece by piece."""

    def __init__(self, source: BinaryIO) -> None:
        self.source, self.inflate, self.raw, self.begun = source, zlib.decompressobj(_GZIP), b"", False
        self.held, self.at = b"", 0

    def _more(self) -> bool:
        """Inflate some more; False at the end. A stream that breaks off is an error."""
        while True:
            if not self.raw:
                self.raw = self.source.read(CHUNK)
            if not self.raw and (not self.begun or self.inflate.eof):
                return False
            if self.inflate.eof:
                self.inflate = zlib.decompressobj(_GZIP)
            at_end, self.begun = not self.raw, True
            # Without input, what the inflater still holds comes out.
            out = self.inflate.decompress(self.raw, CHUNK)
            self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if out:
                self.held, self.at = self.held[self.at :] + out, 0
                return True
            if at_end and not self.inflate.eof:
                raise ValueError("the gzip stream breaks off")

    def line(self) -> bytes:
        """The next line with its end; empty at the end of the stream."""
        while (end := self.held.find(b"\n", self.at)) < 0 and self._more():
            pass
        return self._cut(end + 1 if end >= 0 else len(self.held))

    def _cut(self, end: int) -> bytes:
        out, self.at = self.held[self.at : end], end
        return out

    def take(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes in pieces."""
        while n:
            if self.at == len(self.held) and not self._more():
                raise ValueError("the archive ends inside a record")
            piece = self._cut(min(len(self.held), self.at + n))
            n -= len(piece)
            yield piece


def read_head(source: Inflated) -> tuple[bytes, dict[str, str]] | None:
    """The next record's head as it stands and its fields (names in lower case); None at the end."""
    line = source.line()
    while line and not line.strip():
        line = source.line()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError("no WARC record where one should begin")
    head, fields = [line], {}
    while (line := source.line()).strip():
        name, _, value = line.decode().partition(":")
        fields[name.strip().lower()] = value.strip()
        head.append(line)
    head.append(b"\r\n")
    return b"".join(head), fields


def normalise(source: BinaryIO, archive: BinaryIO, sidecar: BinaryIO) -> int:
    """Rewrite every record of ``source`` as a member of ``archive``; one line per record goes to ``sidecar``.

    A line has the member's ``offset`` and ``length`` and the record's ``type``, ``id``, ``uri`` and
    ``digest``. Memory follows the chunk, not the record. Returns the number of records.
    """
    stream, offset, records = Inflated(source), 0, 0
    while (found := read_head(stream)) is not None:
        head, fields = found
        member, length = zlib.compressobj(_LEVEL, zlib.DEFLATED, _GZIP), 0
        pieces = (p for part in ([head], stream.take(int(fields["content-length"])), [b"\r\n\r\n"]) for p in part)
        for piece in pieces:
            length += archive.write(member.compress(piece))
        length += archive.write(member.flush())
        entry = {"offset": offset, "length": length, "type": fields.get("warc-type"), "id": fields.get("warc-record-id"),
                 "uri": fields.get("warc-target-uri"), "digest": fields.get("warc-payload-digest")}
        sidecar.write(json.dumps(entry).encode() + b"\n")
        offset, records = offset + length, records + 1
    return records


# --- archives of tasks ---------------------------------------------------------------------------


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class _Archive:
    """The archives a task writes, each one gzip stream over all of its records."""

    def __init__(self, folder: str) -> None:
        self.folder, self.out, self.done = folder, None, []

    def add(self, record: bytes) -> None:
        if self.out is None:
            self.path = f"{self.folder}/{uuid.uuid4().hex}.warc.gz"
            system, place = _open(self.path)
            system.create_dir(place.rpartition("/")[0], recursive=True)
            self.out, self.deflate, self.size, self.records = system.open_output_stream(place, compression=None), zlib.compressobj(1, zlib.DEFLATED, _GZIP), 0, 0
            info = _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", _DATE),
                            ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
            self.out.write(self.deflate.compress(info))
        self.out.write(self.deflate.compress(record))
        self.size, self.records = self.size + len(record), self.records + 1
        if self.size >= ARCHIVE_BYTES:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.write(self.deflate.flush())
            self.out.close()
            self.done.append((self.path, self.records))
            self.out = None


def _text(batch: pa.RecordBatch, row: int) -> bytes:
    value = batch.column("html")[row]
    return value.as_buffer().to_pybytes() if value.is_valid else b""


_SCAN = "archive string, records bigint, no bigint, page_id bigint, url string, html string"


def _scan_rows(archives: list[tuple[str, int]], kept: list[tuple]) -> pa.RecordBatch:
    none, n = [None] * len(archives), [None] * len(kept)
    columns = [[a for a, _ in archives] + n, [r for _, r in archives] + n, *[none + [k[i] for k in kept] for i in range(4)]]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
    names = [x.split()[0] for x in _SCAN.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def written(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all pages as records; (``archive``, ``records``) of the archives, each one gzip stream."""
    spark = pages.sparkSession
    read = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    read = read.withColumn("h", F.xxhash64("html"))
    again = read.where(F.octet_length("html") >= LEAST_REVISIT).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    table = spark.sparkContext.broadcast(sieve(again).tobytes())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pages without a copy go into the archive; the others come out as rows."""
        bits, archive, no = np.frombuffer(table.value, np.uint32), _Archive(folder), TaskContext.get().partitionId() << 33
        for batch in batches:
            may = sifted(batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64), bits)
            ids, kept = batch.column("page_id").to_pylist(), []
            for row, page_id in enumerate(ids):
                payload, url, no = _text(batch, row), batch.column("url")[row].as_py(), no + 1
                if may[row] and len(payload) >= LEAST_REVISIT:
                    kept.append((no, page_id, url, payload.decode()))
                else:
                    archive.add(page_record(page_id, url, payload, len(payload), hashlib.sha1(payload).hexdigest(), no, None))
            yield _scan_rows([], kept)
        archive.close()
        yield _scan_rows(archive.done, [])

    first = staged(read.mapInArrow(scan, _SCAN), "warc-scan")
    maybe = first.where("archive IS NULL").select("no", "page_id", "url", "html")
    thin = staged(maybe.select("no", "page_id", F.sha2("html", 256).alias("sha")), "warc-digests")
    # The largest page id of equal payloads; of rows repeated under it the first one.
    keeper = F.max(F.struct(F.col("page_id").alias("page"), (-F.col("no")).alias("after")))
    groups = thin.groupBy("sha").agg(keeper.alias("keep"), F.count(F.lit(1)).alias("n")).select("sha", "keep.page", (-F.col("keep.after")).alias("keep_no"))
    verdicts = staged(thin.join(groups, "sha").select("no", F.col("page").alias("refers_to"), (F.col("no") == F.col("keep_no")).alias("first")), "warc-verdicts")
    keepers = spark.sparkContext.broadcast(sieve(verdicts.where("first").select(F.xxhash64("no").alias("h"))).tobytes())

    def lighten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Size and digest of each payload; the payload itself only where it may be wanted."""
        bits = np.frombuffer(keepers.value, np.uint32)
        for batch in batches:
            may = sifted(batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64), bits)
            payloads = [_text(batch, row) for row in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("no"), batch.column("page_id"), batch.column("url"), pa.array([len(p) for p in payloads], pa.int64()),
                 pa.array([hashlib.sha1(p).hexdigest() for p in payloads], pa.string()), pa.array([p if m else None for p, m in zip(payloads, may, strict=True)], pa.binary())],
                ["no", "page_id", "url", "size", "digest", "payload"])

    light = maybe.withColumn("h", F.xxhash64("no")).mapInArrow(lighten, "no bigint, page_id bigint, url string, size bigint, digest string, payload binary")

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = _Archive(folder)
        for batch in batches:
            for row, r in enumerate(batch.drop_columns(["payload"]).to_pylist()):
                if r["first"]:
                    archive.add(page_record(r["page_id"], r["url"], batch.column("payload")[row].as_py(), r["size"], r["digest"], None, None))
                else:
                    archive.add(page_record(r["page_id"], r["url"], None, r["size"], r["digest"], r["no"], (r["refers_to"],)))
        archive.close()
        yield _scan_rows(archive.done, []).select(["archive", "records"])

    second = staged(light.join(verdicts, "no").mapInArrow(store, "archive string, records bigint"), "warc-copies")
    return staged(first.where("archive IS NOT NULL").select("archive", "records").union(second), "warc-archives")


def _dealt(archives: DataFrame) -> DataFrame:
    """The archives, one to a task as far as possible."""
    return archives.coalesce(1).repartition(max(1, archives.count()))


def normalised(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives with a member per record: (``archive``, ``sidecar``, ``records``) of the new ones.

    Any gzip WARC files will do; ``archives`` names them in its column ``archive``.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("archive").to_pylist():
                target = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                (system, place), (old, source) = _open(target), _open(path)
                system.create_dir(place.rpartition("/")[0], recursive=True)
                with (old.open_input_stream(source, compression=None) as read, system.open_output_stream(place, compression=None) as write,
                      system.open_output_stream(f"{place}.idx", compression=None) as beside):
                    records = normalise(read, write, beside)
                yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([f"{target}.idx"]), pa.array([records])], ["archive", "sidecar", "records"])

    return staged(_dealt(archives.select("archive")).mapInArrow(work, "archive string, sidecar string, records bigint"), "warc-members")


def member(archive: BinaryIO, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """The fields and the block of the record whose member lies at ``offset``."""
    archive.seek(offset)
    inflate = zlib.decompressobj(_GZIP)
    raw = inflate.decompress(archive.read(length))
    if not inflate.eof or inflate.unused_data:
        raise ValueError("the sidecar's length is not that of a member")
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.decode().partition(":") for line in head.split(b"\r\n")[1:])}
    block = rest[: int(fields["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("the record's length is not that of its block")
    return fields, block


_READ = "record_id string, record_type string, url string, page_id bigint, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def page_records(members: DataFrame, with_payload: bool = True) -> DataFrame:
    """The page records of normalised archives, each read at its offset in the sidecar.

    A response's digest is taken from its payload and has to be the one in its head.
    """

    def parsed(fields: dict[str, str], block: bytes) -> dict[str, Any]:
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(next(line for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")).partition(b":")[2])
        whole = lambda name: None if fields.get(name) is None else int(fields[name])
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        response = fields["warc-type"] == "response"
        if response and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
            raise ValueError(f"the payload of {fields['warc-record-id']} is not the one that was written")
        return {"record_id": fields["warc-record-id"], "record_type": fields["warc-type"], "url": fields.get("warc-target-uri"),
                "page_id": whole("page-id"), "refers_to": whole("refers-to-page-id"), "payload_bytes": size, "payload_digest": digest,
                "payload": payload if response and with_payload else None}

    schema = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in _READ.split(", "))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, sidecar in zip(batch.column("archive").to_pylist(), batch.column("sidecar").to_pylist(), strict=True):
                (system, place), rows, size = _open(path), [], 0
                with system.open_input_file(place) as archive, system.open_input_stream(_open(sidecar)[1], compression=None) as beside:
                    for line in _lines(beside):
                        entry = json.loads(line)
                        if entry["type"] not in ("response", "revisit"):
                            continue
                        rows.append(parsed(*member(archive, entry["offset"], entry["length"])))
                        size += len(rows[-1]["payload"] or b"") + 200
                        if size > W.SLICE:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return _dealt(members.select("archive", "sidecar")).mapInArrow(work, _READ)


def _lines(stream: BinaryIO) -> Iterator[bytes]:
    held = b""
    while piece := stream.read(CHUNK):
        *whole, held = (held + piece).split(b"\n")
        yield from whole


def archived_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", with_payload: bool = False) -> DataFrame:
    """Write pages as WARC records, normalise the archives and read them back: one row per page.

    ``page_id``, ``payload_bytes``, ``payload_digest`` (hexadecimal SHA-1), ``record_type``,
    ``refers_to`` and, if asked for, ``url`` and ``payload``. Of equal payloads of at least 1000 bytes
    the one with the largest page id is the response, the others are revisits that refer to it; smaller
    payloads are all responses. A null payload is empty. A null page id never wins against another; if a
    group has no other, ``refers_to`` is null. Of rows repeated under the winning id one is the response.
    A null URL is left out of its record. Other columns are not carried. An empty table gives an empty
    result. Ids are whole numbers.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    members = normalised(written(pages, f"{folder}/whole", id_col, url_col, html_col), f"{folder}/members")
    more = ["url", "payload"] if with_payload else []
    return page_records(members, with_payload).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", *more)
