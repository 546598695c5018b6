"""N-gram Jaccard similarity join by rare-first prefix filtering.

Texts become sets of word n-grams. All sets are ordered alike, rare n-grams first; two sets of
Jaccard similarity t or more then share an n-gram in their prefixes of n - ceil(t n) + 1 members.
Sets meet on prefix n-grams. Pairs are dropped by length, by the positions of the shared n-gram, and
by the suffix filter: counts of each set's members in fixed classes bound the size of the symmetric
difference from below. Each remaining pair is verified once on the whole sets.

What is asked for is how the links connect the documents. Equal sets are one class from the start.
Inside the list of sets that share a prefix n-gram, members are first compared with one leader per
list, so a group of near copies takes as many comparisons as it has members. Afterwards only pairs
whose members are not yet connected are compared, all of them, so that no connection is missed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from paceline.llm import words as W
from paceline.llm.bits import bit_table, with_chance
from paceline.llm.components import components
from paceline.llm.decontamination import sieve, sifted
from paceline.session import staged

#: Cells of the frequency table behind the rare-first order; a fixed size, whatever the corpus.
FREQUENCY_BITS = 20
_CHUNK_BITS = 14
#: Most classes of the suffix filter; smaller sets have fewer, about one for every three members.
CLASSES = 4096
#: Leader rounds before the remaining pairs are listed.
LEADER_ROUNDS = 2


def _sets(part: pa.RecordBatch, width: int) -> W.Sequences:
    return W.distinct(W.shingles(W.word_hashes(part.column("text"), W.blank_separated()), width))


def frequencies(texts: DataFrame, width: int) -> np.ndarray:
    """How many texts hold an n-gram of each hash cell, over all texts.

    Tasks count into a table of fixed size; tables are added up in two levels, chunk by chunk. Only
    the finished table, 4 MB, reaches the driver. It serves as an order: cells that rare n-grams
    share with others only make the filter a little less sharp.
    """
    cells, chunk = 1 << FREQUENCY_BITS, 1 << _CHUNK_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(cells, np.int64)
        for batch in batches:
            for part in W.slices(batch, "text"):
                table += np.bincount((_sets(part, width).values & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
        tables = [t.astype("<u4").tobytes() for t in np.minimum(table, 2**32 - 1).reshape(-1, chunk)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(tables)), pa.int32()), pa.array(tables, pa.binary())], ["chunk", "counts"])

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(chunk, np.int64)
        for counts in rows.column("counts"):
            total += np.frombuffer(counts.as_buffer(), "<u4")
        return pa.table({"chunk": rows.column("chunk").slice(0, 1), "counts": pa.array([np.minimum(total, 2**32 - 1).astype("<u4").tobytes()], pa.binary())})

    schema = "chunk int, counts binary"
    partial = texts.select("text").mapInArrow(count, schema).withColumn("task", F.floor(F.spark_partition_id() / 64))
    level = partial.groupBy("chunk", "task").applyInArrow(add, schema)
    table = np.zeros((cells // chunk, chunk), np.uint32)
    for row in level.groupBy("chunk").applyInArrow(add, schema).collect():
        table[row.chunk] = np.frombuffer(row.counts, "<u4")
    return table.reshape(-1)


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _class_counts(values: np.ndarray) -> bytes:
    """How many members of a set fall into each of a power of two of equal hash ranges, 255 at most.

    Counts that are cut off differ by less than the true ones, so the bound drawn from them holds.
    """
    bits = min(max(int(len(values) // 4).bit_length(), 1), CLASSES.bit_length() - 1)
    counts = np.bincount((values >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _apart(x: bytes, y: bytes) -> int:
    """Members that two sets cannot share, from their class counts; finer classes are added up to the coarser."""
    u, v = np.frombuffer(x, np.uint8).astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)
    least = min(len(u), len(v))
    return int(np.abs(u.reshape(least, -1).sum(1) - v.reshape(least, -1).sum(1)).sum())


def prefixes(texts: DataFrame, order: np.ndarray, width: int, threshold: float) -> DataFrame:
    """Per text: ``n`` (set size), ``sig`` (digest of the set), ``prefix`` (rare first), ``classes``."""
    shared = texts.sparkSession.sparkContext.broadcast(order.tobytes())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(shared.value, "<u4")
        for batch in batches:
            for part in W.slices(batch, "text"):
                values, bounds = _sets(part, width)
                sizes = np.diff(bounds)
                rank = table[(values & np.uint64(len(table) - 1)).astype(np.int64)]
                owner = np.repeat(np.arange(len(sizes)), sizes)
                ordered = values[np.lexsort((values, rank, owner))]
                keep = np.where(sizes > 0, sizes - np.ceil(threshold * sizes - 1e-9).astype(np.int64) + 1, 0)
                ends = np.concatenate([[0], np.cumsum(keep)])
                take = np.repeat(bounds[:-1] - ends[:-1], keep) + np.arange(ends[-1])
                classes = [_class_counts(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(sizes.astype(np.int64)),
                        pa.array([_digest(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ordered[take].view(np.int64))),
                        pa.array(classes, pa.binary()),
                    ],
                    ["doc_id", "n", "sig", "prefix", "classes"],
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(work, f"doc_id {kind}, n bigint, sig binary, prefix array<bigint>, classes binary")


def _needed(threshold: float, n1: Column, n2: Column) -> Column:
    """Shared members that two sets of these sizes need to reach the threshold."""
    return F.ceil(F.lit(threshold / (1 + threshold)) * (n1 + n2) - F.lit(1e-9))


def _may_match(threshold: float, x: str, y: str) -> Column:
    """The length filter and the positional filter for the shared n-gram at positions ``pos``.

    Of the members before the shared n-gram only those that any other set holds too (``met``) can be
    shared; behind it, at most as many as the shorter rest.
    """
    n1, n2, p1, p2 = F.col(f"{x}.n"), F.col(f"{y}.n"), F.col(f"{x}.pos"), F.col(f"{y}.pos")
    length = F.least(n1, n2) >= F.lit(threshold) * F.greatest(n1, n2) - F.lit(1e-9)
    most = F.least(F.col(f"{x}.met"), F.col(f"{y}.met")) + 1 + F.least(n1 - p1 - 1, n2 - p2 - 1)
    return length & (most >= _needed(threshold, n1, n2))


def suffix_filtered(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (``a``, ``b``) whose class counts leave room for enough shared members."""
    one = classes.select(F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("classes").alias("c_a"))
    two = classes.select(F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("classes").alias("c_b"))
    room = F.col("n_a") + F.col("n_b") - 2 * _needed(threshold, F.col("n_a"), F.col("n_b"))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, most = (batch.column(c).to_pylist() for c in ("c_a", "c_b", "room"))
            keep = [_apart(u, v) <= m for u, v, m in zip(x, y, most, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        W.release()

    shapes = pairs.join(one, "a").join(two, "b").select("a", "b", "c_a", "c_b", room.alias("room"))
    return shapes.mapInArrow(sift, "a bigint, b bigint")


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """The pairs whose sets have the wanted similarity, decided on the whole sets.

    Only texts that stand for a class in ``pairs`` are split again. They are found with a bit table
    of fixed size over their ids; texts it lets through by chance drop out in the join on the set.
    """
    spark = texts.sparkSession
    mine = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct().join(classes.select("cid", "doc_id", "sig"), "cid")
    mine = staged(mine, "asked")
    key = F.xxhash64("doc_id")
    shared = spark.sparkContext.broadcast(sieve(mine.select(key.alias("h"))).tobytes())

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(shared.value, np.uint32)
        for batch in batches:
            keep = sifted(batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64), table)
            for part in W.slices(batch.filter(pa.array(keep)), "text"):
                values, bounds = _sets(part, width)
                cuts = [values[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(c) for c in cuts], pa.binary()), pa.array([c.tobytes() for c in cuts], pa.binary())], ["sig", "members"]
                )

    sets = texts.select(key.alias("h"), "text").mapInArrow(split, "sig binary, members binary")
    sets = staged(sets.join(mine.select("cid", "sig"), "sig").select("cid", "members"), "sets")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                u, v = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = np.sort(np.concatenate([u, v]), kind="stable")
                shared_members = int((both[1:] == both[:-1]).sum())
                keep.append(shared_members >= threshold * (len(both) - shared_members) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            W.release()

    x = sets.select(F.col("cid").alias("a"), F.col("members").alias("x"))
    y = sets.select(F.col("cid").alias("b"), F.col("members").alias("y"))
    return pairs.join(x, "a").join(y, "b").mapInArrow(decide, "a bigint, b bigint")


def _leaders(postings: DataFrame, seed: int) -> DataFrame:
    """Per list one member: the best connected one at first, then any by hash."""
    rank = F.col("score") if seed == 0 else F.xxhash64("cid", F.lit(seed))
    row = F.struct(rank.alias("r"), "cid", "n", "pos", "met", "root")
    return postings.groupBy("gram").agg(F.max(row).alias("l")).select("gram", "l.cid", "l.n", "l.pos", "l.met", "l.root")


def _open(postings: DataFrame, roots: DataFrame) -> DataFrame:
    """Postings with their class's current root, of the lists that hold more than one root."""
    held = postings.drop("root").join(roots, postings["cid"] == roots["node"], "left")
    held = held.withColumn("root", F.coalesce("root", "cid")).drop("node")
    mixed = held.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("gram")
    return held.join(mixed, "gram", "left_semi")


def similarity_groups(
    docs: DataFrame, width: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, ``class_id``.

    Words are runs of anything but ASCII white space, A-Z lower-cased. A text with fewer than
    ``width`` words has its whole sequence as only n-gram; a text without words, and a null text,
    has no n-gram, is linked with nothing and is its own component. Two documents are linked when
    the Jaccard similarity of their sets is at least ``threshold``; ``component_id`` is the smallest
    id reachable by links and ``class_id`` the smallest id with the very same set. Null ids count as
    larger than all others; a component of null ids alone has a null component. Rows repeated under
    one id get a row each. Other columns are not carried.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    order = frequencies(texts, width)
    rows = staged(prefixes(texts, order, width, threshold).withColumn("cid", F.monotonically_increasing_id()), "ngram-rows")
    # A class goes by one of its rows; prefixes and class counts stay in ``rows`` alone.
    sigs = rows.where("n > 0").select("sig", "doc_id", "n", "cid")
    classes = staged(sigs.groupBy("sig").agg(F.min("cid").alias("cid"), F.min("doc_id").alias("doc_id"), F.max("n").alias("n")), "ngram-classes")
    copies = staged(sigs.select("sig", F.col("cid").alias("row")).join(classes.select("sig", "cid"), "sig").where("row <> cid").select("row"), "ngram-copies")
    table = staged(bit_table(copies, F.xxhash64("row")), "copy-bits")
    marked = with_chance(rows.where("n > 0").select("cid", "n", "prefix"), F.xxhash64("cid"), table, "may")
    single = marked.where("may").join(copies, F.col("cid") == F.col("row"), "left_anti").unionByName(marked.where("NOT may"))
    shapes = rows.select("cid", "n", "classes")

    lists = single.select("cid", "n", F.posexplode("prefix").alias("pos", "gram"))
    several = lists.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # A window over the prefix of one text: how many of its n-grams come before, and how common they are.
    mine = Window.partitionBy("cid")
    postings = lists.join(several, "gram").withColumn("met", F.row_number().over(mine.orderBy("pos")) - 1)
    postings = postings.withColumn("prev", F.lag("gram").over(mine.orderBy("pos")))
    postings = postings.withColumn("score", F.sum(F.log2("df")).over(mine)).withColumn("root", F.col("cid")).drop("df")
    postings = staged(postings, "postings")

    none = postings.sparkSession.createDataFrame([], "a bigint, b bigint")
    links, roots, at = none, none.select(F.col("a").alias("node"), F.col("b").alias("root")), postings
    tried = none
    for seed in range(LEADER_ROUNDS + 1):
        if seed < LEADER_ROUNDS:
            met = at.alias("x").join(_leaders(at, seed).alias("y"), "gram")
            apart = F.col("x.root") != F.col("y.root")
        else:
            met = at.alias("x").join(at.alias("y"), "gram")
            apart = (F.col("x.cid") < F.col("y.cid")) & (F.col("x.root") != F.col("y.root"))
            # With the same shared n-gram before this one, the pair has met there already, under weaker filters.
            apart = apart & F.coalesce(F.col("x.prev") != F.col("y.prev"), F.lit(True))
        met = met.where(apart & _may_match(threshold, "x", "y"))
        pairs = met.select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).distinct()
        new = staged(suffix_filtered(pairs, shapes, threshold).join(tried, ["a", "b"], "left_anti"), "candidates")
        if not new.isEmpty():
            links = staged(links.union(verified(new, classes, texts, width, threshold)), "ngram-links")
            tried = tried.union(new)
            roots = components(links)
        at = staged(_open(postings, roots), "open-lists")
        if at.isEmpty():
            break

    joined = classes.join(roots, classes["cid"] == roots["node"], "left").select(
        "sig", F.col("doc_id").alias("class_id"), F.coalesce("root", "cid").alias("root")
    )
    joined = staged(joined, "class-roots")
    smallest = joined.groupBy("root").agg(F.min("class_id").alias("component_id"))
    named = joined.join(smallest, "root").select("sig", "class_id", "component_id")
    with_words = rows.where("n > 0").select("doc_id", "n", "sig").join(named, "sig")
    result = with_words.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "class_id")
    empty = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"))
    return result.unionByName(empty)


def keep_one(docs: DataFrame, width: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their component: those with its smallest id.

    Documents without words and rows with a null id stay.
    """
    groups = similarity_groups(docs, width, threshold, id_col, text_col)
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    gone = staged(gone, "near-copies")
    return docs.join(gone, F.col(id_col) == F.col("_gone"), "left_anti")
