"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

A test item is short and a document long, so their Jaccard similarity says little; what counts is the
share of the item's shingles that the document contains. Items are partitioned by size (powers of
two of their shingle count) and each partition has its own MinHash sketch length: the item's k
smallest shingle hashes. At a containment of t an item misses at most (1 - t) q of its q shingles,
so a sketch of more than that many hashes is hit by every document to be found: the search loses
nothing, and the number of hits that a candidate must show follows from k, q and t. Documents with
fewer shingles than the item must find are pruned by size. Candidates are verified by the exact
share of the item's shingles in the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from paceline.llm import words as W
from paceline.session import staged

#: Bits of the sieve in front of the joins: a fixed size, whatever the benchmark's.
SIEVE_BITS = 1 << 23


def _shingled(texts: pa.Array, width: int) -> W.Sequences:
    return W.distinct(W.shingles(W.word_hashes(pc.utf8_lower(texts), W.alphanumeric()), width))


def item_shingles(items: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(``item_id``, ``item_no``, ``shingles``): the distinct shingle hashes of each item, ascending."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                seq = _shingled(part.column("text"), width)
                lists = pa.LargeListArray.from_arrays(pa.array(seq.bounds, pa.int64()), pa.array(seq.values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("item_id"), lists.cast(pa.list_(pa.int64()))], ["item_id", "shingles"])

    kind = items.schema[id_col].dataType.simpleString()
    read = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    return read.mapInArrow(work, f"item_id {kind}, shingles array<bigint>")


def sketches(items: DataFrame, containment: float) -> DataFrame:
    """Each item's size partition, sketch (its k smallest hashes) and the hits a candidate must show."""
    q = F.size("shingles")
    part = F.floor(F.log2(q)).cast("int")
    # The largest item of the partition fixes k, so that all of a partition share one sketch length.
    most_missing = F.floor(F.lit(1 - containment) * (F.pow(F.lit(2), part + 1) - 1) + F.lit(1e-9))
    out = items.where(q > 0).withColumn("q", q).withColumn("part", part)
    out = out.withColumn("k", F.least("q", (most_missing + 1).cast("int")))
    out = out.withColumn("need", F.ceil(F.lit(containment) * F.col("q") - F.lit(1e-9)).cast("int"))
    out = out.withColumn("sketch", F.slice("shingles", F.lit(1), F.col("k")))
    return out.withColumn("hits_needed", F.greatest(F.lit(1), F.col("k") - (F.col("q") - F.col("need"))))


def sieve(hashes: DataFrame, column: str = "h", bits: int = SIEVE_BITS) -> np.ndarray:
    """A bit table of ``bits`` bits with the low bits of every hash set.

    The bits are combined in Spark; at most bits / 32 rows reach the driver, whatever the input.
    """
    rows = hashes.withColumn("_at", F.col(column).bitwiseAND(F.lit(bits - 1))).select(
        F.shiftright("_at", 5).cast("int").alias("w"), F.expr("shiftleft(1L, cast(_at & 31 as int))").alias("m")
    )
    table = np.zeros(bits // 32, np.uint32)
    got = rows.groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()
    table[got.column("w").to_numpy()] = got.column("m").to_numpy().astype(np.uint32)
    return table


def sifted(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the sieve."""
    low = values & np.uint64(len(table) * 32 - 1)
    return (table[(low >> np.uint64(5)).astype(np.int64)] >> (low & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1


def document_hits(docs: DataFrame, tables: tuple, id_col: str, text_col: str, width: int) -> DataFrame:
    """Documents with a possible sketch hit: ``n``, ``sketch_hits`` and ``item_hits``, both sifted."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched, full = (np.frombuffer(t.value, np.uint32) for t in tables)
        for batch in batches:
            for part in W.slices(batch, "text"):
                seq = W.shingles(W.word_hashes(pc.utf8_lower(part.column("text")), W.alphanumeric()), width)
                owner, ids = seq.owners(), part.column("doc_id")
                hit, may = sifted(seq.values, searched), sifted(seq.values, full)
                rows = np.unique(owner[hit])
                if not len(rows):
                    continue
                n = [len(np.unique(seq.values[seq.bounds[r] : seq.bounds[r + 1]])) for r in rows]
                lists = []
                for keep in (hit, may):
                    cuts = [np.unique(seq.values[a:b][keep[a:b]]) for a, b in zip(seq.bounds[rows], seq.bounds[rows + 1], strict=True)]
                    ends = np.concatenate([[0], np.cumsum([len(c) for c in cuts])])
                    flat = pa.array(np.concatenate(cuts).view(np.int64))
                    lists.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows)), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "sketch_hits", "item_hits"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return read.mapInArrow(work, f"doc_id {kind}, n bigint, sketch_hits array<bigint>, item_hits array<bigint>")


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    containment: float = 0.8,
    width: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document and test item that it contains.

    Returns ``doc_id``, ``item_id``, ``item_shingles``, ``shared``, ``containment`` (at least the
    parameter). Words are runs of letters and digits in lower case; shingles have ``width`` words.
    An item of fewer words is one shingle and is found in texts that consist of the same words; an
    item or document without words matches nothing. Null texts are empty. A null id is carried like
    any other; rows repeated under one id count as one document with the best of their containments,
    and items repeated under one id likewise. Other columns are not carried. An empty table on either
    side gives an empty result.

    The documents are read once. A sieve of fixed size in front of the joins passes on only hashes
    that may belong to an item; with a very large benchmark it passes more, and the joins stay exact.
    """
    spark = docs.sparkSession
    catalogue = staged(
        sketches(item_shingles(items, item_id_col, item_text_col, width).withColumn("item_no", F.monotonically_increasing_id()), containment),
        "items",
    )
    sketch = catalogue.select("item_no", "part", "need", "hits_needed", F.explode("sketch").alias("h"))
    whole = catalogue.select("item_no", F.explode("shingles").alias("h"))
    tables = tuple(spark.sparkContext.broadcast(sieve(x).tobytes()) for x in (sketch, whole))
    hits = document_hits(docs, tables, id_col, text_col, width).withColumn("row_no", F.monotonically_increasing_id())
    hits = staged(hits, "document-hits")
    at = hits.select("row_no", "n", F.explode("sketch_hits").alias("h")).join(sketch, "h")
    at = at.where(F.col("n") >= F.col("need"))
    candidates = at.groupBy("row_no", "item_no").agg(F.count(F.lit(1)).alias("c"), F.first("hits_needed").alias("least"))
    candidates = candidates.where(F.col("c") >= F.col("least")).select("row_no", "item_no")
    found = hits.select("row_no", F.explode("item_hits").alias("h")).join(whole, "h").join(candidates, ["row_no", "item_no"])
    shared = found.groupBy("row_no", "item_no").agg(F.count(F.lit(1)).alias("shared"))
    rows = shared.join(catalogue.select("item_no", "item_id", "q", "need"), "item_no").where(F.col("shared") >= F.col("need"))
    best = rows.join(hits.select("row_no", "doc_id"), "row_no").groupBy("doc_id", "item_id").agg(
        F.max(F.struct((F.col("shared") / F.col("q")).alias("containment"), "shared", F.col("q").alias("item_shingles"))).alias("b")
    )
    return best.select("doc_id", "item_id", F.col("b.item_shingles").cast("long").alias("item_shingles"),
                       F.col("b.shared").alias("shared"), F.col("b.containment").alias("containment"))
