"""Weighted rendezvous sharding of stable record keys, with slots inside each shard."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from paceline.session import staged

#: Rows that one slot window numbers, about.
SLOT_ROWS = 20_000


def lot(key: Column, shard: int, weight: float) -> Column:
    """The lot a key draws for a shard: exponential with rate ``weight``; the smallest lot wins."""
    if not (weight > 0 and math.isfinite(weight)):
        raise ValueError("a shard's weight is a positive number")
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double")
    return -F.log((bits + F.lit(0.5)) * F.lit(2.0**-53)) / F.lit(float(weight))


def rendezvous(df: DataFrame, key: Column, weights: Sequence[float], grown_by: float | None = None) -> DataFrame:
    """Add ``shard`` (0 to len(weights) - 1) and ``grown_shard``.

    A row goes to the shard for which its key draws the smallest lot, so only the key and the shards
    decide; equal lots go to the lower shard. ``grown_shard`` is the shard with one more of weight
    ``grown_by``: it equals ``shard`` or is the new one. Without ``grown_by`` it is null.
    A null key is a key like any other. No rows are moved, nothing is collected.
    """
    if not weights:
        raise ValueError("at least one shard is needed")
    lots = [F.struct(lot(key, s, w).alias("lot"), F.lit(s).alias("shard")) for s, w in enumerate(weights)]
    out = df.withColumn("_best", F.array_min(F.array(*lots)))
    grown = F.lit(None).cast("int")
    if grown_by is not None:
        newer = lot(key, len(weights), grown_by) < F.col("_best.lot")
        grown = F.when(newer, F.lit(len(weights))).otherwise(F.col("_best.shard"))
    return out.withColumn("shard", F.col("_best.shard")).withColumn("grown_shard", grown).drop("_best")


def slots(df: DataFrame, shard: str, order: Sequence[str], rows: int | None = None) -> DataFrame:
    """Add ``slot``: 0, 1, 2, … inside each shard, without a gap.

    Each shard is cut into cells by a hash of the ``order`` columns. Rows are numbered inside their
    cell, and the counts of the cells before it are added. Rows equal in all ``order`` columns share
    a cell; which of them comes first is not defined. ``df`` is read twice: pass a written table.
    """
    rows = df.count() if rows is None else rows
    cells = max(1, math.ceil(rows / (SLOT_ROWS * max(1, df.select(shard).distinct().count()))))
    cut = df.withColumn("_cell", F.pmod(F.xxhash64(*order), F.lit(cells)))
    before = Window.partitionBy(shard).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy(shard, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(shard, "_cell").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    numbered = cut.withColumn("_at", F.row_number().over(inside) - 1)
    out = numbered.join(offsets, [shard, "_cell"])
    return out.withColumn("slot", (F.col("_offset") + F.col("_at")).cast("long")).drop("_cell", "_at", "_offset")


def shard_documents(
    docs: DataFrame,
    weights: Sequence[float],
    grown_by: float | None = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    ``size`` is the UTF-8 length of the text plus 16 for the record; a null text has no bytes and the
    CRC of an empty one. Rows with a null id follow the key null; repeated rows get a slot each.
    Other columns are not carried. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    small = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = staged(rendezvous(small, F.col("doc_id"), weights, grown_by), "shards")
    out = slots(placed, "shard", ["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
