import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from paceline.llm import anchors as A
from paceline.llm import suffix_dedup as S
from paceline.llm import words as W
from paceline.llm.anchors import anchors


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in texts:
        for s in range(len(b) - length + 1):
            key = b[s : s + length]
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            f = first.get(b[s : s + length])
            if f is not None and (i is None or f < i):
                gone[s : s + length] = True
        rest = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def got(table, **kw):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.repeated_passages(table, **kw).collect()), key=str)


def corpus(seed, docs, alphabet, longest):
    rnd = random.Random(seed)
    text = lambda n: "".join(rnd.choice(alphabet) for _ in range(n))
    texts = []
    for _ in range(docs):
        parts = [text(rnd.randrange(longest))]
        for _ in range(rnd.randrange(3)):
            if texts:
                source = rnd.choice(texts)
                a = rnd.randrange(len(source) + 1)
                parts.append(source[a : a + rnd.randrange(longest)])
                parts.append(text(rnd.choice([0, 1, 9])))
        texts.append("".join(parts) if rnd.random() > 0.1 or not texts else rnd.choice(texts))
    ids = list(range(docs))
    rnd.shuffle(ids)
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("length,anchor,alphabet,seed", [(50, 32, "abcdefgh é", 1), (12, 7, "ab", 2), (8, 7, "abc\0", 3), (20, 4, "abcd", 4)])
def test_same_as_brute_force(docs, monkeypatch, length, anchor, alphabet, seed):
    monkeypatch.setattr(S, "SHARD_BYTES", 1500)
    rows = corpus(seed, 80, alphabet, 3 * length)
    assert got(docs(rows), length=length, anchor=anchor) == brute(rows, length)


def test_odd_rows(docs, monkeypatch):
    monkeypatch.setattr(S, "SHARD_BYTES", 400)
    long = "the same long passage of more than fifty bytes, which repeats in documents"
    rows = [(5, long), (5, long), (5, long + " x"), (9, long), (2, "y" + long), (None, long), (None, "a" + long + "b"), (7, None), (8, ""), (1, "short"),
            (3, "short"), (11, "z" * 500), (12, "z" * 300), (13, "ab" * 200), (14, long + long)]
    assert got(docs(rows)) == brute(rows, 50)
    assert got(docs([])) == [] and got(docs([(1, None)])) == brute([(1, None)], 50)


def test_transforms_and_merge_order_all_suffixes():
    rnd = np.random.default_rng(3)
    strings = [bytes(rnd.integers(1, 4, rnd.integers(0, 14)).astype(np.uint8)) for _ in range(41)]
    matrix = np.zeros((len(strings), 14), np.uint8)
    for k, s in enumerate(strings):
        matrix[k, : len(s)] = np.frombuffer(s, np.uint8)
    lengths = np.array([len(s) for s in strings])
    before, row, place = S.transform(matrix, lengths)
    suffixes = [strings[r][p:] + b"\0" for r, p in zip(row, place, strict=True)]
    assert suffixes == sorted(suffixes) and len(suffixes) == lengths.sum() + len(strings)
    assert all(b == (strings[r][p - 1] if p else 0) for b, r, p in zip(before, row, place, strict=True))
    half = 20
    one, two = S.transform(matrix[:half], lengths[:half]), S.transform(matrix[half:], lengths[half:])
    of_second, interval, common = S.interleave(one[0], two[0], 5)
    a, b = iter(zip(one[1], one[2], strict=True)), iter((r + half, p) for r, p in zip(two[1], two[2], strict=True))
    cyclic = [(strings[r][p:] + b"\0" + (strings[r] + b"\0") * 5)[:5] for r, p in (next(b) if z else next(a) for z in of_second)]
    assert cyclic == sorted(cyclic)
    for k in range(1, len(cyclic)):
        same = next((j for j in range(5) if cyclic[k][j] != cyclic[k - 1][j]), 5)
        assert common[k] == same and (interval[k] == interval[k - 1]) == (same == 5)


@pytest.mark.parametrize("length,width", [(50, 32), (10, 4), (7, 7), (8, 3)])
def test_equal_runs_hold_equal_anchors(length, width):
    rnd = random.Random(length)
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.randrange(120))) for _ in range(20)]
    raw, bounds = W.text_buffer(pa.array(texts))
    at, hashes = anchors(raw, bounds, length, width)
    held = {}
    for i, t in enumerate(texts):
        for s in range(len(t) - length + 1):
            p = bounds[i] + s
            inside = set((at[(at >= p) & (at + width <= p + length)] - p).tolist())
            held[t[s : s + length]] = held.get(t[s : s + length], inside) & inside
    assert all(held.values())
    assert all(any(a <= x and x + width <= b for a, b in zip(bounds[:-1], bounds[1:], strict=True)) for x in at)


def test_contexts_inside_and_at_the_ends_of_texts():
    """Contexts of anchors inside a text are windows of the shard; all are the bytes round the anchor, and none of the next text."""
    rnd = random.Random(8)
    texts = ["".join(rnd.choice("ab\0c") for _ in range(n)) for n in (50, 51, 120, 400, 60)]
    shard = S._Shard(pa.table({"doc_id": list(range(5)), "text": texts}), 50, 32)
    at, _, owner = shard.anchors
    rows, lengths, lead = S._contexts(shard, at, owner)
    whole = shard.body.tobytes().replace(b"\0", bytes([S._NUL_SYMBOL]))
    assert len(at) > 30
    for k, p in enumerate(at):
        before = whole[max(p - 18, shard.edges[owner[k]]) : p]
        after = whole[p + 32 : min(p + 50, shard.edges[owner[k] + 1])]
        want = before + bytes([S._ANCHOR_SYMBOL]) + after
        assert (rows[k].tobytes(), lengths[k], lead[k]) == (want.ljust(37, b"\0"), len(want), len(before))


def test_transform_sorts_numbers_and_not_places(monkeypatch):
    """Sorting packed numbers takes a fraction of the time of an indirect sort of wide keys."""
    rnd = np.random.default_rng(6)
    strings = rnd.integers(1, 3, (200, 37)).astype(np.uint8)
    strings[100:] = strings[:100]
    lengths = np.full(200, 37)
    indirect, wide = np.argsort, []
    monkeypatch.setattr(S.np, "argsort", lambda a, **kw: (wide.append(len(a)) if a.dtype.itemsize == 8 else None) or indirect(a, **kw))
    _, row, place = S.transform(strings, lengths)
    assert not wide
    suffixes = [strings[r, p:].tobytes() for r, p in zip(row, place, strict=True)]
    assert suffixes == sorted(suffixes)


def test_only_chosen_runs_are_hashed(monkeypatch):
    """Numbers of 32 bits choose the anchors; 64-bit hashes are made of those alone."""
    mix, sizes = W.mix, []
    monkeypatch.setattr(W, "mix", lambda x: sizes.append(len(x)) or mix(x))
    raw, bounds = W.text_buffer(pa.array(random.Random(5).randbytes(4000).hex() for _ in range(5)))
    at, hashes = anchors(raw, bounds, 50, 32)
    assert len(at) == len(hashes) == max(sizes) < len(raw) // 5


def test_runs_whose_number_would_be_nought_are_anchors(monkeypatch):
    monkeypatch.setattr(A, "_CODE", np.zeros(256, np.uint32))
    raw, bounds = W.text_buffer(pa.array(["a" * 49, "b" * 60, "", "c" * 50]))
    at, _ = anchors(raw, bounds, 50, 32)
    assert at.tolist() == [*range(49, 78), *range(109, 128)]


def test_anchors_are_merged_some_at_a_time(monkeypatch):
    """The contexts of many anchors do not go into one transform, and the smallest documents are those of all runs."""
    monkeypatch.setattr(S, "MERGE_CONTEXTS", 40, raising=False)
    transform, sizes = S.transform, []
    monkeypatch.setattr(S, "transform", lambda strings, lengths: sizes.append(len(strings)) or transform(strings, lengths))
    rnd = np.random.default_rng(9)
    side, depth, n = 3, 4, 600
    lead, after = rnd.integers(0, side + 1, n), rnd.integers(0, side + 1, n)
    hashes, owner = rnd.integers(0, 150, n).astype(np.uint64), rnd.integers(0, 50, n)
    rows = np.zeros((n, 2 * side + 1), np.uint8)
    for k in range(n):
        rows[k, : lead[k] + 1 + after[k]] = rnd.integers(97, 99, lead[k] + 1 + after[k])
        rows[k, lead[k]] = S._ANCHOR_SYMBOL
    best = S._first_owners(hashes, rows, lead + 1 + after, lead, owner, depth)
    assert max(sizes) < 40 and sum(sizes) > 500
    first = {}
    runs = [(k, o, (hashes[k], rows[k, o : o + depth].tobytes())) for k in range(n) for o in range(lead[k] + 1) if o + depth <= lead[k] + 1 + after[k]]
    for k, _, run in runs:
        first[run] = min(first.get(run, owner[k]), owner[k])
    assert all(best[k, o] == first[run] for k, o, run in runs) and any(best[k, o] < owner[k] for k, o, _ in runs)


@pytest.mark.parametrize("parts", [1, 7, 1000])
def test_parts_of_sorted_hashes_are_slices(parts):
    """A shard's rows for the parts are cut from sorted hashes, not looked up once for each part."""
    hashes = np.sort(np.random.default_rng(2).integers(0, 1 << 64, 500, dtype=np.uint64))
    part = S._parts(hashes, parts)
    assert part.min() >= 0 and part.max() < parts
    found = S._slices(part)
    assert [p for p, *_ in found] == np.unique(part).tolist()
    assert all((np.flatnonzero(part == p) == np.arange(a, b)).all() for p, a, b in found)
    assert S._slices(part[:0]) == [] and S._parts(np.array([0, (1 << 64) - 1], np.uint64), parts).tolist() == [0, parts - 1]
