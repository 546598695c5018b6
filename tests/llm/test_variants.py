import random
import re
import zlib
from collections import Counter

import pytest

from paceline.llm import variants as V


def brute(rows, least=3):
    """All words, all pairs, straight from the definition."""
    total = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            total[run] += 1
    words = {w: n for w, n in total.items() if len(w) >= 5 and n >= least}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        short, long = sorted((a, b), key=len)
        return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    links = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(links[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, n, len(links[w]), form[w], words.get(form[w]), root))
    return out


def got(df):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


@pytest.mark.parametrize("slabs", [1, 7])
def test_against_brute_force(spark, docs, slabs):
    rnd = random.Random(5)
    base = ["".join(rnd.choice("abé") for _ in range(rnd.choice([4, 5, 6, 8, 12]))) for _ in range(160)] + ["aaaaaa", "aaaaa", "aaaaaaa", "Ünder", "ünder", "straße"]
    rows = []
    for i in range(300):
        words = [rnd.choice(base) if rnd.random() < 0.7 else base[min(int(rnd.expovariate(0.08)), len(base) - 1)] for _ in range(rnd.choice([0, 5, 60]))]
        words = [w.upper() if rnd.random() < 0.1 else w for w in words]
        rows.append((rnd.choice([i, i, None]), rnd.choice([" ", ", ", "—9 "]).join(words)))
    rows += [(None, None), (5, ""), (7, "aaaaaa " * 9), (7, "aaaaaa " * 9)]
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", slabs)
    try:
        table = docs(rows)
        found = got(V.spelling_variants(table))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    want = brute(rows)
    assert found == want and len(want) > 100
    assert any(f is not None and r != f for *_, f, _, r in want) and any(n > 5 for _, _, n, *_ in want)


def test_counts_do_not_depend_on_pieces(docs, monkeypatch):
    text = "Wörter wordy wordy worda " * 4000
    monkeypatch.setattr(V.W, "SLICE", 1 << 10)
    monkeypatch.setattr(V, "GATHERED", 2)
    rows = [(1, text), (2, "x" * 300_000 + " wordy"), (3, ("y" * 5000 + " ") * 3)]
    assert got(V.spelling_variants(docs(rows))) == brute(rows)


def test_empty_inputs(docs):
    for rows in ([], [(1, None), (2, "")], [(1, "ab abc once twice")]):
        df = V.spelling_variants(docs(rows))
        assert df.columns == ["word", "n", "n_near", "form", "form_n", "root"] and df.collect() == []
