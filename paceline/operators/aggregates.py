"""Aggregates of ledgers and logs (2.4). All of them combine on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paceline.functions.moments import monday_of
from paceline.keys import RACE
from paceline.operators.ordered import distribution, n_values

STATUSES = ["ok", "no_odds", "fail"]


def distinct_count(df: DataFrame, by: Sequence[str], col: str, name: str) -> DataFrame:
    """``countDistinct`` per group; Spark spreads a hot group over its distinct values first."""
    return df.groupBy(*by).agg(F.countDistinct(col).alias(name))


def p95_abs(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    return distribution(df, by, F.abs(F.col(value)), {"p95": 0.95}, [n_values().alias("n"), F.max("v").alias("max_abs")])


def status_counts(log: DataFrame, default_offset: float = 5.0) -> DataFrame:
    """Attempts by offset and status, long to wide; rows without an offset count as ``default_offset``."""
    offset = F.coalesce(F.col("target_offset_min").try_cast("double"), F.lit(default_offset))
    hits = [F.count(F.when(F.col("status") == s, 1)).alias(f"n_{s}") for s in STATUSES]
    return log.groupBy(offset.alias("target_offset_min")).agg(*hits)


def status_pivot(log: DataFrame) -> DataFrame:
    wide = log.groupBy("target_offset_min").pivot("status", STATUSES).agg(F.count(F.lit(1)))
    return wide.select("target_offset_min", *[F.coalesce(s, F.lit(0).cast("long")).alias(f"n_{s}") for s in STATUSES])


def mean_std(df: DataFrame, by: Sequence[str], value: Column) -> DataFrame:
    """n, mean and sample deviation (0 for a single row)."""
    return df.groupBy(*by).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std"))


def ok_races(log: DataFrame) -> DataFrame:
    """Distinct races with at least one good capture."""
    return log.where(F.col("status") == "ok").agg(F.countDistinct(*RACE).alias("n_races"))


def value_table(df: DataFrame, col: Column, name: str) -> DataFrame:
    """Frequencies, blanks labelled."""
    label = F.coalesce(F.nullif(F.trim(col.cast("string")), F.lit("")), F.lit("(blank)"))
    return df.groupBy(label.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def stratified(df: DataFrame) -> DataFrame:
    return df.groupBy("status", F.year("race_date").alias("year")).agg(F.count(F.lit(1)).alias("n"))


def max_payout(payouts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return payouts.groupBy(*keys).agg(F.max("payout").alias("payout"))


def daily_counts(tables: dict[str, DataFrame], start: str, end: str) -> DataFrame:
    """Rows per table and calendar day; days without rows are kept with zeros."""
    spark = next(iter(tables.values())).sparkSession
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("race_date"))
    out = days
    for name, df in tables.items():
        inside = df.where(F.col("race_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        out = out.join(inside.groupBy("race_date").agg(F.count(F.lit(1)).alias(name)), "race_date", "left")
    return out.select("race_date", *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in tables])


def week_rollup(df: DataFrame, aggs: Sequence[Column]) -> DataFrame:
    """The same aggregates per ISO week and in total."""
    out = df.withColumn("week", monday_of(F.col("race_date"))).rollup("week").agg(*aggs)
    return out.withColumn("week", F.coalesce(F.date_format("week", "yyyy-MM-dd"), F.lit("total")))
