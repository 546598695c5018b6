"""Removal of repeated passages with merged Burrows-Wheeler transforms.

Texts are dealt to shards. Every run of ``LENGTH`` bytes holds an anchor, a shorter run that equal
passages choose alike, so a passage that two documents share shows as an anchor that both hold. Only
anchors of several documents go on, each with the bytes around it (its context); the anchor itself
shrinks to one symbol. Contexts with equal anchors meet in one task. There the contexts are split in
halves, the Burrows-Wheeler transform of each half is built, and the two are merged by iterative
interleave refinement: the interleave of order k + 1 follows from that of order k by one stable
distribution over the merged symbols, and where neighbours first part gives their longest common
prefix. Suffixes are not sorted again for the merge. Intervals whose common prefix spans a whole run
are the repeated runs; the smallest document in one is where the run came first.

An anchor with very many contexts is not gathered: its runs are compared one by one, as an aggregation
by the run's bytes with a map-side combine, so that no task holds all surroundings of one passage.
"""

from __future__ import annotations

import functools
import hashlib
import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from paceline.llm import words as W
from paceline.llm.anchors import anchors
from paceline.session import scratch_path, staged

LENGTH = 50
ANCHOR = 32
#: Text bytes of a shard and context bytes of a merge task, about.
SHARD_BYTES = 8 << 20
#: Shards whose marks a task compares, about.
MARKS_SHARDS = 4
#: Places of an anchor from which on its runs are compared one by one.
HOT_PLACES = 20_000
#: Text bytes whose anchors are chosen at once, and contexts transformed and merged at once: their arrays stay in a core's cache.
ANCHOR_BYTES = 1 << 17
MERGE_CONTEXTS = 1000
#: Symbols that UTF-8 never uses: the anchor, a NUL byte of the text, and the end of a context (0).
_ANCHOR_SYMBOL, _NUL_SYMBOL = 0xC0, 0xC1
_LAST = np.iinfo(np.int64).max


# --- Burrows-Wheeler transforms of a collection of short strings ---------------------------------


def _stable(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    """``order`` sorted by the keys (below 2^32) of its items, stably: key and place in one number, which is sorted as a value."""
    packed = (keys[order].astype(np.uint64) << np.uint64(32)) | np.arange(len(order), dtype=np.uint64)
    packed.sort()
    return order[(packed & np.uint64(0xFFFFFFFF)).astype(np.int64)]


def transform(strings: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The transform of strings (rows of a zero-padded matrix without zero bytes inside).

    Returns the symbols before each suffix in suffix order (0 before a whole string), and for each
    suffix the row and place it starts at. Each string ends with a 0 of its own; ends are ordered
    like the strings, which is what the merge relies on.
    """
    n, width = strings.shape
    rank_of = np.argsort(np.ascontiguousarray(strings).view(f"S{width}").ravel(), kind="stable")
    strings, lengths = strings[rank_of], lengths[rank_of]
    sizes = lengths + 1
    ends = np.cumsum(sizes)
    begins = ends - sizes
    row = np.repeat(np.arange(n), sizes)
    place = np.arange(ends[-1]) - begins[row]
    padded = np.concatenate([strings, np.zeros((n, 1), np.uint8)], axis=1)
    text = padded[row, place]
    left = sizes[row] - place  # symbols up to and with the end

    key, tail = np.zeros(len(text), np.uint64), np.concatenate([text, np.zeros(8, np.uint8)])
    for k in range(8):
        key = (key << np.uint64(8)) | np.where(left > k, tail[k : k + len(text)], 0).astype(np.uint64)
    low, high = key & np.uint64(0xFFFFFFFF), key >> np.uint64(32)
    order, span = _stable(high, _stable(low, np.arange(len(text)))), 8
    ordered = key[order]
    fresh = ordered[1:] != ordered[:-1]
    while True:
        rank = np.empty(len(text), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(fresh)])
        if span > width:
            break
        ahead = np.zeros(len(text), np.int64)
        ahead[:-span] = rank[span:] + 1
        ahead[left <= span] = 0
        # The order by what lies ahead is the present order moved back, behind the suffixes that end before.
        moved = order - span
        moved = moved[moved >= 0]
        moved = moved[left[moved] > span]
        order, span = _stable(rank, np.concatenate([np.flatnonzero(left <= span), moved])), span * 2
        ordered, beyond = rank[order], ahead[order]
        fresh = (ordered[1:] != ordered[:-1]) | (beyond[1:] != beyond[:-1])
    before = text[order - 1]
    before[place[order] == 0] = 0
    return before, rank_of[row[order]], place[order]


def interleave(first: np.ndarray, second: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge two transforms up to ``depth`` symbols.

    Returns, in merged order, whether a suffix is of the second collection, the number of its interval
    of suffixes with equal first ``depth`` symbols, and its longest common prefix with the suffix
    before it, as far as ``depth``.
    """
    size = len(first) + len(second)
    of_second = np.zeros(size, bool)
    of_second[len(first) :] = True
    interval = np.zeros(size, np.int32)
    common = np.zeros(size, np.int16)
    symbols, part = np.empty(size, np.uint8), np.ones(size, bool)
    for _ in range(depth):
        # Each collection's symbols come in their own order.
        symbols[np.flatnonzero(of_second)] = second
        symbols[np.flatnonzero(~of_second)] = first
        moved = np.argsort(symbols, kind="stable")
        of_second = of_second[moved]
        ahead, was = symbols[moved], interval[moved]
        part[1:] = (ahead[1:] != ahead[:-1]) | (was[1:] != was[:-1])
        # Neighbours that part in one round stay parted.
        common += ~part
        interval = np.cumsum(part, dtype=np.int32) - 1
    return of_second, interval, common


def repeated_runs(strings: np.ndarray, lengths: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and interval of all runs of ``depth`` symbols that occur at two places at least."""
    half = len(lengths) // 2
    one, two = transform(strings[:half], lengths[:half]), transform(strings[half:], lengths[half:])
    of_second, interval, _ = interleave(one[0], two[0], depth)
    row, place = np.empty(len(of_second), np.int64), np.empty(len(of_second), np.int64)
    row[~of_second], place[~of_second] = one[1], one[2]
    row[of_second], place[of_second] = two[1] + half, two[2]
    # A run that reaches the end of its string is none.
    whole = place + depth <= lengths[row]
    row, place, interval = row[whole], place[whole], interval[whole]
    several = np.bincount(interval)[interval] > 1 if len(interval) else np.zeros(0, bool)
    return row[several], place[several], interval[several]


# --- Shards ---------------------------------------------------------------------------------------


class _Shard:
    """The different texts of a shard with their anchors; the same for the same rows in any order."""

    def __init__(self, rows: pa.Table, length: int, width: int) -> None:
        ids = rows.column("doc_id").to_numpy(zero_copy_only=False) if rows.column("doc_id").null_count == 0 else np.array(
            [_LAST if x is None else x for x in rows.column("doc_id").to_pylist()], np.int64)
        self.ids = ids.astype(np.int64)
        self.raw, self.bounds = W.text_buffer(pc.fill_null(rows.column("text"), "").combine_chunks())
        texts = [self.raw[a:b].tobytes() for a, b in zip(self.bounds[:-1], self.bounds[1:], strict=True)]
        order = sorted(range(len(texts)), key=lambda k: (self.ids[k], texts[k]))
        self.first: dict[bytes, int] = {}
        for k in order:
            self.first.setdefault(texts[k], k)
        self.texts, self.order, self.length, self.width = texts, order, length, width
        kept = sorted(self.first.values(), key=lambda k: (self.ids[k], texts[k]))
        self.kept = np.array(kept, np.int64)
        self.body = np.frombuffer(b"".join(texts[k] for k in kept), np.uint8)
        self.edges = np.concatenate([[0], np.cumsum([len(texts[k]) for k in kept])]).astype(np.int64)

    @functools.cached_property
    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place, hash and owner (among the kept texts) of all anchors, piece by piece of the shard."""
        at, hashes, begin = [], [], 0
        while begin < len(self.kept):
            end = max(begin + 1, int(np.searchsorted(self.edges, self.edges[begin] + ANCHOR_BYTES, "right")) - 1)
            a, b = self.edges[begin], self.edges[end]
            found, h = anchors(self.body[a:b], self.edges[begin : end + 1] - a, self.length, self.width)
            at.append(found + a)
            hashes.append(h)
            begin = end
        at, hashes = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((at, np.int64), (hashes, np.uint64)))
        return at, hashes, np.searchsorted(self.edges, at, "right") - 1


def _binary(*arrays: np.ndarray) -> list[pa.Array]:
    return [pa.array([a.tobytes()], pa.binary()) for a in arrays]


def _parts(values: np.ndarray, parts: int) -> np.ndarray:
    """The part of each hash (of less than 2^32 parts); larger hashes have no smaller part."""
    return (((values >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _slices(parts: np.ndarray) -> list[tuple[int, int, int]]:
    """Each part that occurs in the ascending parts, where it begins and where it ends."""
    begins = np.flatnonzero(np.diff(parts, prepend=-1))
    return list(zip(parts[begins].tolist(), begins.tolist(), np.append(begins, len(parts))[1:].tolist(), strict=True))


def _contexts(shard: _Shard, at: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes around anchors as rows with the anchor as one symbol; their lengths and the anchor's place."""
    side = shard.length - shard.width
    lead = np.minimum(side, at - shard.edges[owner])
    after = np.minimum(side, shard.edges[owner + 1] - at - shard.width)
    col = np.arange(2 * side + 1)
    out = np.empty((len(at), 2 * side + 1), np.uint8)
    # Where the text goes on to both sides, the bytes are those of a window; only at its ends are they picked one by one.
    inner = (lead == side) & (after == side)
    if inner.any():
        windows = np.lib.stride_tricks.sliding_window_view(shard.body, 2 * side + shard.width)[at[inner] - side]
        out[inner] = np.concatenate([windows[:, : side + 1], windows[:, side + shard.width :]], axis=1)
    edge = ~inner
    source = (at - lead)[edge][:, None] + col + np.where(col > lead[edge][:, None], shard.width - 1, 0)
    out[edge] = shard.body[np.minimum(source, max(len(shard.body) - 1, 0))]
    out[out == 0] = _NUL_SYMBOL
    out[col == lead[:, None]] = _ANCHOR_SYMBOL
    lengths = lead + 1 + after
    out[col >= lengths[:, None]] = 0
    return out, lengths, lead


def _distinct_rows(hashes: np.ndarray, rows: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and inverse of the different (hash, lead, row) triples.

    Triples are ordered by a hash of all their bytes; should different ones agree in it, by the bytes.
    """
    gap = -(8 + 1 + rows.shape[1]) % 8
    whole = np.concatenate([hashes.view(np.uint8).reshape(len(hashes), 8), lead.astype(np.uint8)[:, None], rows, np.zeros((len(rows), gap), np.uint8)], axis=1)
    words, key = np.ascontiguousarray(whole).view(np.uint64), np.zeros(len(rows), np.uint64)
    for k in range(words.shape[1]):
        key = W.mix(key + words[:, k])
    _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    if (words[first[inverse]] != words).any():
        flat = np.ascontiguousarray(whole).view([("", f"V{whole.shape[1]}")]).ravel()
        _, first, inverse = np.unique(flat, return_index=True, return_inverse=True)
    return first, inverse


def _among(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Whether each key is one of ``wanted``; most are ruled out by a table of their low bits."""
    table, low = np.zeros(1 << 22, bool), np.uint64((1 << 22) - 1)
    table[(wanted & low).astype(np.int64)] = True
    out = table[(keys & low).astype(np.int64)]
    wanted, left = np.sort(wanted), keys[out]
    out[out] = wanted[np.minimum(np.searchsorted(wanted, left), len(wanted) - 1)] == left
    return out


def _first_owners(hashes: np.ndarray, rows: np.ndarray, lengths: np.ndarray, lead: np.ndarray, owner: np.ndarray, depth: int) -> np.ndarray:
    """For each context (distinct) and run in it, the smallest document that holds that run."""
    best = np.repeat(owner[:, None], depth, axis=1)
    order = np.argsort(hashes, kind="stable")
    fresh = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])[: len(order)])
    sizes = np.diff(np.append(fresh, len(order)))
    several = order[np.repeat(sizes > 1, sizes)]
    # Contexts of one anchor stay together; anchors are merged some at a time.
    ends = np.cumsum(sizes[sizes > 1])
    for pick in np.split(several, ends[:-1][np.diff(ends // MERGE_CONTEXTS) > 0]):
        if not len(pick):
            continue
        row, place, interval = repeated_runs(rows[pick], lengths[pick], depth)
        row = pick[row]
        holds = (place <= lead[row]) & (place + depth > lead[row])
        row, place, interval = row[holds], place[holds], interval[holds]
        if not len(row):
            continue
        group = np.lexsort((hashes[row], interval))
        row, place, interval = row[group], place[group], interval[group]
        fresh = np.concatenate([[True], (interval[1:] != interval[:-1]) | (hashes[row][1:] != hashes[row][:-1])])
        least = np.minimum.reduceat(owner[row], np.flatnonzero(fresh))[np.cumsum(fresh) - 1]
        best[row, place] = np.minimum(best[row, place], least)
    return best


# --- The operator ---------------------------------------------------------------------------------


def _sharded(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """``doc_id``, ``text`` and ``shard`` as a table bucketed by shard, so that later steps shuffle no text."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first().n or 0
    shards = max(1, math.ceil(size / SHARD_BYTES))
    buckets = min(shards, 4096)
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt = read.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.crc32(F.col("text").cast("binary"))), F.lit(shards)))
    name = f"paceline_shards_{uuid.uuid4().hex}"
    writer = dealt.repartition(buckets, "shard").write.bucketBy(buckets, "shard").option("compression", "zstd")
    writer.option("path", scratch_path(spark, "text-shards")).saveAsTable(name)
    return spark.table(name), shards


def repeated_passages(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``kept``.

    A byte is removed if a run of ``length`` bytes that covers it also starts in a document with a
    smaller id; runs lie inside one text. ``n_spans`` counts the maximal removed runs; ``kept`` holds
    the remaining bytes. Null and empty texts have no bytes. A null id counts as larger than all
    others, and rows with one id, or null ids, do not remove from each other. Other columns are not
    carried. An empty table gives an empty result. Ids are whole numbers.
    """
    side = length - anchor
    if not 0 < side < 32:
        raise ValueError("the anchor takes 1 to 31 bytes less than the run")
    depth, width = side + 1, 2 * side + 1
    table, shards = _sharded(docs, id_col, text_col)
    # Marks are dealt to parts of several shards' worth; a shard gives a row per part, and never more rows than marks.
    marks_parts = max(1, shards // MARKS_SHARDS)
    most = HOT_PLACES

    def fingerprints(rows: pa.Table) -> pa.Table:
        shard = _Shard(rows, length, anchor)
        _, hashes, owner = shard.anchors
        order = np.argsort(hashes)
        sorted_hashes, documents = hashes[order], shard.ids[shard.kept[owner[order]]]
        fresh = np.flatnonzero(np.concatenate([[True], sorted_hashes[1:] != sorted_hashes[:-1]])[: len(sorted_hashes)])
        if not len(fresh):
            return pa.table({"marks_part": pa.array([], pa.int64()), "shard": pa.array([], pa.int64()), "marks": pa.array([], pa.binary()), "multi": pa.array([], pa.binary()), "places": pa.array([], pa.binary())})
        several = np.minimum.reduceat(documents, fresh) != np.maximum.reduceat(documents, fresh)
        # Places of each anchor, as the next power of two.
        places = np.ceil(np.log2(np.diff(np.append(fresh, len(sorted_hashes))))).astype(np.uint8)
        marks, part = sorted_hashes[fresh], _parts(sorted_hashes[fresh], marks_parts)
        out = [(p, marks[a:b], several[a:b], places[a:b]) for p, a, b in _slices(part)]
        return pa.table({
            "marks_part": pa.array([p for p, *_ in out], pa.int64()), "shard": pa.array([rows.column("shard")[0].as_py()] * len(out), pa.int64()),
            # Inside a part the low half tells marks apart; a chance agreement costs a context, not a wrong result.
            "marks": pa.array([(m & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() for _, m, _, _ in out], pa.binary()),
            "multi": pa.array([np.packbits(s).tobytes() for _, _, s, _ in out], pa.binary()),
            "places": pa.array([n.tobytes() for *_, n in out], pa.binary()),
        })

    def shared(rows: pa.Table) -> pa.Table:
        marks = [np.frombuffer(x.as_buffer(), np.uint32) for x in rows.column("marks")]
        flat, ends = np.concatenate(marks), np.cumsum([len(m) for m in marks])[:-1]
        multi = np.concatenate([np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8))[: len(m)] for x, m in zip(rows.column("multi"), marks, strict=True)])
        places = np.concatenate([np.left_shift(1, np.frombuffer(x.as_buffer(), np.uint8).astype(np.int64)) for x in rows.column("places")])
        # One sort of the part's marks, each with its place in one number.
        packed = (flat.astype(np.uint64) << np.uint64(32)) | np.arange(len(flat), dtype=np.uint64)
        packed.sort()
        place, mark = (packed & np.uint64(0xFFFFFFFF)).astype(np.int64), packed >> np.uint64(32)
        fresh = np.flatnonzero(np.concatenate([[True], mark[1:] != mark[:-1]]))
        counts = np.diff(np.append(fresh, len(mark)))
        several = (counts > 1) | np.logical_or.reduceat(multi[place] > 0, fresh)
        many = np.add.reduceat(places[place], fresh) > most
        wanted, hot = np.empty(len(flat), bool), np.empty(len(flat), bool)
        wanted[place], hot[place] = np.repeat(several, counts), np.repeat(many, counts)
        of = lambda keep: pa.array([m[k].tobytes() for m, k in zip(marks, np.split(keep, ends), strict=True)], pa.binary())
        return pa.table({"shard": rows.column("shard"), "marks_part": rows.column("marks_part"), "marks": of(wanted & ~hot), "hot": of(wanted & hot)})

    def hits(shard: _Shard, marks: pa.Table, kind: str = "marks") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, hashes, owner = shard.anchors
        wanted = [
            (np.uint64(p.as_py()) << np.uint64(32)) | np.frombuffer(m.as_buffer(), np.uint32).astype(np.uint64)
            for p, m in zip(marks.column("marks_part"), marks.column(kind), strict=True) if p.is_valid and len(m.as_buffer())
        ]
        if not wanted:
            return at[:0], hashes[:0], owner[:0]
        keep = _among((_parts(hashes, marks_parts).astype(np.uint64) << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF)), np.concatenate(wanted))
        return at[keep], hashes[keep], owner[keep]

    def local_contexts(shard: _Shard, marks: pa.Table) -> tuple:
        at, hashes, owner = hits(shard, marks)
        rows, lengths, lead = _contexts(shard, at, owner)
        first, inverse = _distinct_rows(hashes, rows, lead) if len(at) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        # By hash, so that a part is a slice.
        order = np.argsort(hashes[first], kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        first, inverse = first[order], number[inverse]
        least = np.full(len(first), _LAST)
        np.minimum.at(least, inverse, shard.ids[shard.kept[owner]])
        return at, owner, lead, inverse, hashes[first], rows[first], lengths[first], lead[first], least

    def local_runs(shard: _Shard, marks: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Begin and owner of the runs that hold a hot anchor, the different runs, each one's number and smallest document."""
        at, _, owner = hits(shard, marks, "hot")
        begin, owner = (at[:, None] - np.arange(depth)).ravel(), np.repeat(owner, depth)
        fits = (begin >= shard.edges[owner]) & (begin + length <= shard.edges[owner + 1])
        begin, first = np.unique(begin[fits], return_index=True)
        owner = owner[fits][first]
        if not len(begin):
            return begin, owner, np.zeros(0, f"V{length}"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        runs = np.lib.stride_tricks.sliding_window_view(shard.body, length)[begin]
        runs, number = np.unique(np.ascontiguousarray(runs).view(f"V{length}").ravel(), return_inverse=True)
        least = np.full(len(runs), _LAST)
        np.minimum.at(least, number, shard.ids[shard.kept[owner]])
        return begin, owner, runs, number, least

    def hot_runs(rows: pa.Table, marks: pa.Table) -> pa.Table:
        runs, least, shard = np.zeros(0, f"V{length}"), np.zeros(0, np.int64), 0
        if rows.num_rows and marks.num_rows:
            *_, runs, _, least = local_runs(_Shard(rows, length, anchor), marks)
            shard = rows.column("shard")[0].as_py()
        return pa.table({
            "run": pa.array([x.tobytes() for x in runs], pa.binary()), "shard": pa.array([shard] * len(runs), pa.int64()),
            "number": pa.array(np.arange(len(runs)), pa.int64()), "least": pa.array(least, pa.int64()),
        })

    def contexts(rows: pa.Table, marks: pa.Table) -> pa.Table:
        out: dict[str, list] = {"part": [], "shard": [], "hashes": [], "rows": [], "lengths": [], "lead": [], "least": []}
        if rows.num_rows and marks.num_rows:
            *_, hashes, strings, lengths, lead, least = local_contexts(_Shard(rows, length, anchor), marks)
            for p, a, b in _slices(_parts(hashes, shards)):
                out["part"].append(p)
                out["shard"].append(rows.column("shard")[0].as_py())
                for name, x in (("hashes", hashes), ("rows", strings), ("lengths", lengths.astype(np.uint8)), ("lead", lead.astype(np.uint8)), ("least", least)):
                    out[name].append(x[a:b].tobytes() if name != "rows" else pa.compress(x[a:b].tobytes(), codec="zstd", asbytes=True))
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 5]
        return pa.table({n: pa.array(v, t) for (n, v), t in zip(out.items(), kinds, strict=True)})

    def merged(rows: pa.Table) -> pa.Table:
        load = lambda name, kind: [np.frombuffer(x.as_buffer(), kind) for x in rows.column(name)]
        hashes, lengths, lead, least = (load(n, k) for n, k in (("hashes", np.uint64), ("lengths", np.uint8), ("lead", np.uint8), ("least", np.int64)))
        ends = np.cumsum([len(x) for x in hashes])
        all_hashes, all_least = np.concatenate(hashes), np.concatenate(least)
        texts = [pa.decompress(x.as_buffer(), len(n) * width, codec="zstd") for x, n in zip(rows.column("rows"), lengths, strict=True)]
        strings = np.concatenate([np.frombuffer(x, np.uint8) for x in texts]).reshape(-1, width)
        lead_of = np.concatenate(lead).astype(np.int64)
        first, inverse = _distinct_rows(all_hashes, strings, lead_of)
        owner = np.full(len(first), _LAST)
        np.minimum.at(owner, inverse, all_least)
        best = _first_owners(all_hashes[first], strings[first], np.concatenate(lengths).astype(np.int64)[first], lead_of[first], owner, depth)
        bits = np.zeros(len(all_hashes), np.uint32)
        for o in range(depth):
            bits |= (best[inverse, o] < all_least).astype(np.uint32) << np.uint32(o)
        return pa.table({"shard": rows.column("shard"), "part": rows.column("part"), "bits": pa.array([b.tobytes() for b in np.split(bits, ends[:-1])], pa.binary())})

    def cut(rows: pa.Table, marks: pa.Table) -> pa.Table:
        out: dict[str, list] = {"doc_id": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
        if rows.num_rows:
            shard = _Shard(rows, length, anchor)
            removed = np.zeros(len(shard.body) + 1, bool)  # where removed runs begin
            if marks.num_rows:
                at, owner, lead, inverse, hashes, _, lengths, _, least = local_contexts(shard, marks)
                bits = np.zeros(len(hashes), np.uint32)
                where = {p: (a, b) for p, a, b in _slices(_parts(hashes, shards))}
                for p, b in zip(marks.column("part"), marks.column("bits"), strict=True):
                    if p.is_valid and b.is_valid:
                        bits[slice(*where[p.as_py()])] = np.frombuffer(b.as_buffer(), np.uint32)
                # Runs that hold the anchor and lie inside the context; in a later document of this shard all of them come again.
                fits = np.clip(np.minimum(lead, lengths[inverse] - depth) + 1, 0, depth).astype(np.uint64)
                inside = ((np.uint64(1) << fits) - np.uint64(1)).astype(np.uint32)
                mine = shard.ids[shard.kept[owner]] > least[inverse]
                again = inside & np.where(mine, inside, bits[inverse])
                context, place = np.nonzero(np.unpackbits(again.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little"))
                removed[(at - lead)[context] + place] = True
                begin, owner, runs, number, least = local_runs(shard, marks)
                before = np.zeros(len(runs), bool)
                for numbers in marks.column("numbers"):
                    if numbers.is_valid:
                        before[np.array(numbers.as_py(), np.int64)] = True
                removed[begin[before[number] | (shard.ids[shard.kept[owner]] > least[number])]] = True
            begin, change = np.flatnonzero(removed), np.zeros(len(shard.body) + 1, np.int32)
            change[begin] = 1
            change[begin + length] -= 1
            gone = np.cumsum(change[:-1], dtype=np.int32) > 0
            place = {int(k): j for j, k in enumerate(shard.kept)}
            for k, text in enumerate(shard.texts):
                j = place[shard.first[text]]
                mask = gone[shard.edges[j] : shard.edges[j + 1]]
                if shard.ids[k] > shard.ids[shard.first[text]] and len(text) >= length:
                    mask = np.ones(len(text), bool)
                rest = np.frombuffer(text, np.uint8)[~mask].tobytes()
                out["doc_id"].append(rows.column("doc_id")[k].as_py())
                out["n_bytes"].append(len(text))
                out["n_removed"].append(len(text) - len(rest))
                out["n_spans"].append(int((np.diff(np.concatenate([[0], mask.view(np.int8)])) == 1).sum()))
                out["kept_sha256"].append(hashlib.sha256(rest).hexdigest())
                out["kept"].append(rest)
        kinds = [*[pa.int64()] * 4, pa.string(), pa.binary()]
        return pa.table({n: pa.array(v, t) for (n, v), t in zip(out.items(), kinds, strict=True)})

    marks = table.groupBy("shard").applyInArrow(fingerprints, "marks_part bigint, shard bigint, marks binary, multi binary, places binary")
    wanted = marks.groupBy("marks_part").applyInArrow(shared, "shard bigint, marks_part bigint, marks binary, hot binary")
    wanted = staged(wanted.where((F.length("marks") > 0) | (F.length("hot") > 0)), "shared-marks")
    by_shard = lambda df: table.groupBy("shard").cogroup(df.groupBy("shard"))
    found = by_shard(wanted).applyInArrow(
        contexts, "part bigint, shard bigint, hashes binary, rows binary, lengths binary, lead binary, least binary"
    )
    bits = staged(found.groupBy("part").applyInArrow(merged, "shard bigint, part bigint, bits binary"), "repeat-bits")
    asked = wanted.unionByName(bits, allowMissingColumns=True).withColumn("numbers", F.lit(None).cast("array<bigint>"))
    hot = wanted.where(F.length("hot") > 0)
    if not hot.isEmpty():
        # A shard gives a run once, so a run has at most as many rows as there are shards.
        runs = staged(by_shard(hot).applyInArrow(hot_runs, "run binary, shard bigint, number bigint, least bigint"), "hot-runs")
        first = runs.groupBy("run").agg(F.min("least").alias("first"))
        again = runs.join(first, "run").where("first < least").groupBy("shard").agg(F.collect_list("number").alias("numbers"))
        asked = asked.unionByName(staged(again, "hot-again"), allowMissingColumns=True)
    return by_shard(asked).applyInArrow(
        cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    )
