"""Hard negatives by slots: overlapping score windows of an anchor answered from disjoint parts of the score axis.

Every anchor is scored against all rows, block by block as matrix products. A first pass keeps each
anchor's best rows of its own label, its positives. Each positive asks for the best rows of other
labels inside a window below its own score. The upper limits of an anchor's windows split the score
axis into disjoint slots. In the second pass a row falls into one slot, and combiners keep the best few
rows per slot: inside a block, then over the blocks of a task, then over tasks. A window's rows are the
best of all slots below its upper limit, so the slots from there on down, one behind the other and cut
to the wanted number, are the answer of all windows that end there; the lower limit is applied last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from paceline.session import staged

#: Rows and anchors of a block: one matrix product takes a block of each.
BLOCK_ROWS, BLOCK_ANCHORS = 4096, 512
#: Blocks of rows that one combiner goes through, and blocks of anchors that meet them in one task, at most.
BUNDLE_ROWS, BUNDLE_ANCHORS = 32, 64
#: Whole numbers up to this size are exact in a double.
_EXACT = float(1 << 53)
_FAR, _LOW = np.iinfo(np.int64).max, np.iinfo(np.int64).min


def taking_part(
    rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256
) -> DataFrame:
    """(``vec_id``, ``label``, ``vec``, ``anchor``): rows that take part, components scaled and rounded down.

    A row with a null label or vector, or with a component that is null, NaN or infinite (before or
    after scaling), takes no part.
    """
    scaled = F.transform(F.col(vector_col), lambda v: v.cast("double") * scale)
    read = rows.where(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), scaled.alias("vec"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    sound = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    # A component beyond 2^53 is whole as it is, and its floor need not fit a long.
    whole = F.transform("vec", lambda v: F.when(F.abs(v) < _EXACT, F.floor(v).cast("double")).otherwise(v))
    return read.where(F.coalesce(sound, F.lit(False))).withColumn("vec", whole)


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """Rows of components; a shorter vector is filled up with zeros."""
    ends = vectors.offsets.to_numpy()
    flat, sizes = vectors.flatten().to_numpy(zero_copy_only=False), np.diff(ends)
    width = int(sizes.max()) if len(sizes) else 0
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _blocked(rows: DataFrame, size: int) -> DataFrame:
    """Rows packed into blocks: ``block`` (a number), ``n`` and the columns as binary."""
    spark = rows.sparkSession
    n = rows.count()
    parts = max(1, -(-n // size), min(n // 64, spark.sparkContext.defaultParallelism))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = pa.Table.from_batches([batch.slice(at, size)]).combine_chunks().to_batches()[0]
                ids, known = part.column("vec_id").fill_null(_FAR).to_numpy(), part.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
                body = [ids, known, part.column("label").to_numpy(), part.column("no").to_numpy(), _matrix(part.column("vec"))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.num_rows]), *[pa.array([b.tobytes()], pa.binary()) for b in body]], ["n", "ids", "known", "labels", "nos", "vecs"])

    dealt = rows.select("vec_id", "label", "no", "vec").repartition(parts, F.xxhash64("no"))
    packed = dealt.mapInArrow(pack, "n bigint, ids binary, known binary, labels binary, nos binary, vecs binary")
    return packed.withColumn("block", F.monotonically_increasing_id())


def _unpacked(rows: pa.Table, row: int) -> tuple[np.ndarray, ...]:
    """Ids (null as the largest), labels, row numbers and vectors of a block."""
    load = lambda c, kind: np.frombuffer(rows.column(c)[row].as_buffer(), kind)
    ids = np.where(load("known", bool), load("ids", np.int64), _FAR)
    return ids, load("labels", np.int64), load("nos", np.int64), load("vecs", float).reshape(rows.column("n")[row].as_py(), -1)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole inner products of all rows of ``a`` and ``b``, exact at any size of the components.

    Doubles are used where they are exact. Larger products are taken as Python's whole numbers; beyond
    64 bits they are cut off at the ends of that range.
    """
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(width, 1)
    if largest < _EXACT:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(v) for v in r] for r in m], object).reshape(m.shape)
    return np.clip(whole(a) @ whole(b).T, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, nos: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each group: highest score, then smallest id, then row number."""
    order = np.lexsort((nos, ids, -score, group))
    g = group[order]
    first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
    rank = np.arange(len(g)) - np.repeat(first, np.diff(np.append(first, len(g))))
    return order[rank < k]


_FOUND = "block bigint, anchor bigint, slot int, score bigint, vec_id bigint, no bigint"


class _Combiner:
    """The first ``k`` rows per anchor (of one block) and slot; ``floor`` is the score that a further row has to reach."""

    def __init__(self, anchors: int, slots: int, k: int) -> None:
        self.k, self.slots = k, slots
        self.floor = np.full((anchors, slots), _LOW)
        self.held = tuple(np.zeros(0, np.int64) for _ in range(5))

    def add(self, anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, nos: np.ndarray) -> None:
        if not len(anchor):
            return
        held = tuple(np.concatenate(c) for c in zip(self.held, (anchor, slot, score, ids, nos), strict=True))
        group = held[0] * self.slots + held[1]
        keep = _best(group, *held[2:], self.k)
        self.held, group = tuple(c[keep] for c in held), group[keep]
        last = np.flatnonzero(np.append(group[1:] != group[:-1], True))
        full = np.diff(np.concatenate([[-1], last])) == self.k
        self.floor.reshape(-1)[group[last[full]]] = self.held[2][last[full]]


def _pass(anchors: DataFrame, rows: DataFrame, bundles: tuple[int, int], k: int, mine: bool) -> DataFrame:
    """The first ``k`` rows per anchor and slot over all rows: of the own label, or of others inside the slots.

    A task has one bundle of anchor blocks beside one bundle of row blocks; each row block is sent once
    per bundle of anchors and each anchor block once per bundle of rows. Null ids come back as the largest.
    """

    def meet(_: tuple, few: pa.Table, many: pa.Table) -> pa.Table:
        out = []
        blocks = [_unpacked(many, i) for i in range(many.num_rows)]
        for a in range(few.num_rows):
            _, labels, names, vectors = _unpacked(few, a)
            if not mine:
                upper = np.frombuffer(few.column("upper")[a].as_buffer(), np.int64).reshape(len(names), -1)
                lower = np.frombuffer(few.column("lower")[a].as_buffer(), np.int64)[:, None]
            best = _Combiner(len(names), 1 if mine else upper.shape[1], k)
            for ids, row_labels, nos, vecs in blocks:
                score = scores(vectors, vecs)
                same = labels[:, None] == row_labels[None, :]
                if mine:
                    take, slots = same & (names[:, None] != nos[None, :]) & (score >= best.floor), None
                else:
                    # Upper limits fall from slot to slot: a score belongs to the last slot whose limit it keeps.
                    slots = sum((score <= upper[:, j : j + 1]).astype(np.int64) for j in range(upper.shape[1])) - 1
                    take = ~same & (slots >= 0) & (score >= lower)
                    take &= score >= np.take_along_axis(best.floor, np.maximum(slots, 0), 1)
                anchor, other = np.nonzero(take)
                slot = np.zeros(len(anchor), np.int64) if mine else slots[anchor, other]
                best.add(anchor, slot, score[anchor, other], ids[other], nos[other])
            anchor, slot, score, ids, nos = best.held
            block = np.full(len(anchor), few.column("block")[a].as_py(), np.int64)
            out.append((block, names[anchor], slot.astype(np.int32), score, ids, nos))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, t) for t in (np.int64, np.int64, np.int32, *[np.int64] * 3)]
        return pa.table(dict(zip(("block", "anchor", "slot", "score", "vec_id", "no"), columns, strict=True)))

    def dealt(df: DataFrame, own: int, other: int, names: tuple[str, str]) -> DataFrame:
        part = F.pmod(F.xxhash64("block"), F.lit(own)).cast("int").alias(names[0])
        return df.select("*", part, F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias(names[1]))

    left = dealt(anchors, bundles[0], bundles[1], ("few", "many")).groupBy("few", "many")
    right = dealt(rows, bundles[1], bundles[0], ("many", "few")).groupBy("few", "many")
    found = left.cogroup(right).applyInArrow(meet, _FOUND)
    rank = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id", "no"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _limited(anchors: DataFrame, limits: DataFrame, most: int) -> DataFrame:
    """Anchor blocks with their anchors' upper limits (falling; ``most`` each) and lowest lower limit.

    An anchor without windows has limits that no score keeps.
    """

    def pack(_: tuple, blocks: pa.Table, rows: pa.Table) -> pa.Table:
        _, _, names, _ = _unpacked(blocks, 0)
        place = {n: i for i, n in enumerate(names.tolist())}
        upper, lower = np.full((len(names), most), _LOW), np.full(len(names), _FAR)
        for name, uppers, low in zip(*(rows.column(c).to_pylist() for c in ("anchor", "uppers", "lower")), strict=True):
            upper[place[name], : len(uppers)] = sorted(uppers, reverse=True)
            lower[place[name]] = low
        return blocks.append_column("upper", pa.array([upper.tobytes()], pa.binary())).append_column("lower", pa.array([lower.tobytes()], pa.binary()))

    schema = ", ".join(f"{n} {t}" for n, t in anchors.dtypes) + ", upper binary, lower binary"
    return anchors.groupBy("block").cogroup(limits.groupBy("block")).applyInArrow(pack, schema)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Scores are whole inner products of the components, scaled by 256 and rounded down. An anchor's
    positives are its first ``positives`` other rows of its label, by falling score, then by id. Per
    positive the first ``negatives`` rows of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score`` are returned.

    ``is_anchor`` is a condition on the columns of ``rows``; null means no anchor. Rows with a null label
    or vector, or a null, infinite or NaN component, take no part. A null id is larger than all others.
    Repeated rows are rows of their own, an anchor's copy can be one of its positives. Vectors of
    different lengths are compared over the components both have; an empty vector scores 0. A positive
    with a score below zero has no window. Other columns are not carried. An empty table, or one
    without anchors, gives an empty result.
    """
    if not 0 < low <= high:
        raise ValueError("windows lie between two positive shares of the positive's score")
    part = taking_part(rows, is_anchor, id_col, vector_col, label_col)
    everyone = staged(part.withColumn("no", F.monotonically_increasing_id()), "vectors")
    blocks = staged(_blocked(everyone, BLOCK_ROWS), "vector-blocks")
    anchors = staged(_blocked(everyone.where("anchor"), BLOCK_ANCHORS), "anchor-blocks")
    n, tasks = blocks.count(), rows.sparkSession.sparkContext.defaultParallelism
    bundles = (max(1, -(-anchors.count() // BUNDLE_ANCHORS)), max(1, -(-n // BUNDLE_ROWS), min(n, tasks)))

    mates = staged(_pass(anchors, blocks, bundles, positives, True), "positives")
    # Whole limits inside the window; equal upper limits are one slot.
    share = lambda f, x: f(F.col("score").cast("decimal(20,0)") * x / 100).cast("long")
    windows = mates.where("score >= 0").select(
        "block", "anchor", F.col("vec_id").alias("positive"), F.col("score").alias("positive_score"), share(F.floor, high).alias("upper"), share(F.ceil, low).alias("lower"))
    windows = staged(windows.withColumn("slot", F.dense_rank().over(Window.partitionBy("anchor").orderBy(F.desc("upper"))) - 1), "windows")
    limits = windows.groupBy("block", "anchor").agg(F.collect_set("upper").alias("uppers"), F.min("lower").alias("lower"))
    asking = staged(_limited(anchors, limits, positives), "limited-anchors")
    found = _pass(asking, blocks, bundles, negatives, False)

    # Slots one behind the other are in the order of their rows: from any slot on down the first rows are the answer.
    entry = F.struct("slot", "rank", F.col("vec_id").alias("id"), "score")
    slots = found.groupBy("anchor").agg(F.array_sort(F.collect_list(entry)).alias("slots"))
    suffix = F.slice(F.filter("slots", lambda x: x["slot"] >= F.col("slot")), 1, negatives)
    hits = windows.join(slots, "anchor").select(
        "anchor", "positive", "positive_score", F.posexplode(F.filter(suffix, lambda x: x["score"] >= F.col("lower"))).alias("at", "hit"))
    named = everyone.where("anchor").select(F.col("no").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    known = lambda c: F.when(c < _FAR, c)
    return hits.join(named, "anchor").select(
        "anchor_id", known(F.col("positive")).alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"), known(F.col("hit.id")).alias("negative_id"),
        "positive_score", F.col("hit.score").alias("negative_score"))
