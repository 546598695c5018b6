"""Filters, coercion and imputation (2.2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paceline.keys import CAR, COMBO, RACE, in_race
from paceline.operators.dedup import first_per_key, newest_per_key
from paceline.operators.ordered import distribution


def date_range(df: DataFrame, start: str | None, end: str | None, date: str = "race_date") -> DataFrame:
    """Closed range; a missing bound is open."""
    out = df if start is None else df.where(F.col(date) >= F.lit(start).cast("date"))
    return out if end is None else out.where(F.col(date) <= F.lit(end).cast("date"))


def positive_odds(df: DataFrame) -> DataFrame:
    return df.withColumn("odds", F.col("odds").try_cast("double")).where(F.col("odds") > 0)


def where_over(df: DataFrame, keep: Column) -> DataFrame:
    """Filter on a window expression."""
    return df.withColumn("_keep", keep).where("_keep").drop("_keep")


def clean_races(df: DataFrame, win: str = "y_win") -> DataFrame:
    """Races with exactly one winner."""
    return where_over(df, F.sum(win).over(in_race()) == 1)


def complete_market(df: DataFrame, price: str = "mkt_win") -> DataFrame:
    """Races in which every runner has a market price."""
    return where_over(df, F.count(F.lit(1)).over(in_race()) == F.count(price).over(in_race()))


def mass_band(df: DataFrame, col: str, low: float = 0.995, high: float = 1.005, min_cars: int = 5) -> DataFrame:
    total = F.sum(col).over(in_race())
    return where_over(df, (F.count("car_no").over(in_race()) >= min_cars) & (total > low) & (total < high))


def payouts_clean(payouts: DataFrame, order: Sequence[Column], keep: str = "last") -> DataFrame:
    """Payouts above zero, one per combination (first or last in ``order``), with realised odds."""
    live = payouts.withColumn("payout", F.col("payout").try_cast("int")).where(F.col("payout") > 0)
    pick = newest_per_key if keep == "last" else first_per_key
    return pick(live, COMBO, order, ["payout"]).withColumn("realized_odds", F.col("payout") / 100)


def distinct_races(entries: DataFrame) -> DataFrame:
    """One row per race with its first start time."""
    return entries.groupBy(*RACE).agg(F.min("st_time").alias("st_time"))


def coerce_numeric(df: DataFrame, kinds: dict[str, str], required: Sequence[str]) -> DataFrame:
    """Unparsable values become NULL; rows without a required value are dropped."""
    out = df.withColumns({c: F.trim(F.col(c).cast("string")).try_cast(k) for c, k in kinds.items()})
    return out.dropna(subset=list(required))


def impute_flags(df: DataFrame) -> DataFrame:
    """Missing price flags and the median front-running propensity over all cars."""
    median = distribution(df, [], F.col("nige_propensity"), {"m": 0.5}).first()["m"]
    return df.withColumns({
        "has_odds": F.coalesce("has_odds", F.lit(0)),
        "is_incomplete_st2": F.coalesce("is_incomplete_st2", F.lit(1)),
        "nige_propensity": F.coalesce("nige_propensity", F.lit(median)),
    })


def attach_sparse(df: DataFrame, features: DataFrame) -> DataFrame:
    """Left join that leaves features of uncovered cars NULL."""
    return df.join(features, CAR, "left")


def top_n_report(df: DataFrame, order: Sequence[Column], n: int = 15) -> DataFrame:
    """The first ``n`` rows of a report, with the number of rows not shown."""
    rest = df.agg(F.greatest(F.count(F.lit(1)) - n, F.lit(0)).alias("n_rest"))
    return df.orderBy(*order).limit(n).withColumn("n_rest", rest.scalar())


def stratified_head(df: DataFrame, stratum: str, order: Sequence[Column], per_stratum: int, total: int) -> DataFrame:
    """The first rows of every stratum, then the first of all. Spark limits each input partition first."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy(stratum).orderBy(*order))
    return df.withColumn("rk", rank).where(F.col("rk") <= per_stratum).orderBy("rk", stratum, *order).limit(total)


def max_rows_sample(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
