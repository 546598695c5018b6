"""Ranks, gaps and moments within a race, and ordered splits of the race table.

The race windows run on frames with one row per (race, car); car numbers are single digits, so a
partition holds the runners of one race. Splits over all races go through ``ordered.running``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from paceline.keys import RACE, in_race
from paceline.operators.dedup import first_per_key
from paceline.operators.ordered import distribution, positions

RATES = ["syouritu", "rentairitu2", "rentairitu3", "heikin_tokuten"]
GAPS = ["syouritu", "rentairitu2", "heikin_tokuten"]
# Riding styles and their column names.
STYLES = {"逃": "n_nige_in_race", "追": "n_oikomi_in_race", "両": "n_ryouten_in_race"}
SUPPORT_STYLES = ["追", "両"]


def dense_rank_in_race(col: str, descending: bool = True) -> Column:
    """Dense rank in the race; a NULL value has no rank."""
    order = F.desc_nulls_last(col) if descending else F.asc_nulls_last(col)
    return F.when(F.col(col).isNotNull(), F.dense_rank().over(in_race().orderBy(order)))


def rank_in_race(df: DataFrame) -> DataFrame:
    new = {f"{c}_rank": dense_rank_in_race(c) for c in RATES}
    return df.withColumns({**new, "age_rank": dense_rank_in_race("age", descending=False)})


def gap_to_leader(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{c}_gap": F.max(c).over(in_race()) - F.col(c) for c in GAPS})


def race_moments(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "race_n_cars": F.count("car_no").over(in_race()),
        "race_mean_syouritu": F.avg("syouritu").over(in_race()),
        "race_std_syouritu": F.coalesce(F.stddev_samp("syouritu").over(in_race()), F.lit(0.0)),
    })


def race_style_counts(df: DataFrame) -> DataFrame:
    def hits(cond: Column) -> Column:
        return F.sum(F.coalesce(cond, F.lit(False)).cast("long")).over(in_race())

    counts = {name: hits(F.col("kyaku") == style) for style, name in STYLES.items()}
    return df.withColumns({**counts, "n_S_class_in_race": hits(F.col("kyuhan").startswith("S"))})


def normalise_in_race(df: DataFrame, col: str, name: str) -> DataFrame:
    total = F.sum(col).over(in_race())
    return df.withColumn(name, F.col(col) / F.when(total == 0, F.lit(1.0)).otherwise(total))


def support_excl_self(df: DataFrame, group: str, name: str) -> DataFrame:
    """Supporting riders of the same group in the race, without the rider."""
    own = F.coalesce(F.col("kyaku").isin(SUPPORT_STYLES), F.lit(False)).cast("long")
    total = F.sum(own).over(in_race(group))
    return df.withColumn(name, F.greatest(total - own, F.lit(0)))


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows per group. Spark pushes the limit below the shuffle (WindowGroupLimit)."""
    return df.withColumn("rk", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rk") <= k)


def argmax(df: DataFrame, by: Sequence[str], score: str, tie: str) -> DataFrame:
    """The row with the largest score, smallest ``tie`` first; rows without a score do not count."""
    scored = df.where(F.col(score).isNotNull())
    return first_per_key(scored, by, [-F.col(score), F.col(tie)])


def block_split(races: DataFrame, k: int, order: Sequence[str] = RACE) -> DataFrame:
    """Distinct races in order, cut into ``k`` blocks of equal size."""
    ordered = positions(races.select(*order).distinct(), [], [F.col(c) for c in order])
    return ordered.withColumn("blk", F.floor((F.col("pos") - 1) * k / F.col("pos_all")))


def cum_tail_split(df: DataFrame, head: float, date: str = "race_date") -> DataFrame:
    """Mark the rows after the ``head`` quantile of the dates as validation."""
    day = F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))
    edge = distribution(df, [], day, {"_edge": head})
    cut = edge.first()["_edge"]
    return df.withColumn("part", F.when(day > F.lit(cut), "valid").otherwise("train"))
