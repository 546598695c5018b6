"""A bit table of fixed size as a small broadcast join: which rows of a large table may have their key in another.

The table has a row per 64 bits, so its size is bounded whatever the input. It says no for certain and
yes perhaps; what it lets through is decided exactly afterwards, and rows it rejects need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Rows of the table at most; 64 bits each.
WORDS = 1 << 17


def _word(key: Column) -> Column:
    """Leading bits of a 64-bit key, so that keys are to be well mixed."""
    return F.shiftrightunsigned(key, 64 - 17)


def _bit(key: Column) -> Column:
    return F.shiftrightunsigned(key, 64 - 23).bitwiseAND(F.lit(63))


_MASK = "shiftleft(1L, cast(_bit as int))"


def bit_table(keys: DataFrame, key: Column) -> DataFrame:
    """(``_word``, ``_bits``) with the bits of all keys set; at most ``WORDS`` rows."""
    return keys.select(_word(key).alias("_word"), _bit(key).alias("_bit")).groupBy("_word").agg(F.bit_or(F.expr(_MASK)).alias("_bits"))


def with_chance(rows: DataFrame, key: Column, table: DataFrame, name: str) -> DataFrame:
    """``rows`` with the boolean ``name``: whether the key may be among those of ``table``."""
    columns = rows.columns
    met = rows.withColumn("_word", _word(key)).withColumn("_bit", _bit(key)).join(F.broadcast(table), "_word", "left")
    hit = F.coalesce(F.col("_bits").bitwiseAND(F.expr(_MASK)) != 0, F.lit(False))
    return met.select(*columns, hit.alias(name))
