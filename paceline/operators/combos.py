"""Runner probabilities to combination probabilities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from paceline.functions.rows import inline_rows
from paceline.functions.numeric import settle
from paceline.keys import CAR, MARKET, RACE, in_race
from paceline.operators.ordered import distribution, mean_value


def field_pairs(runners: DataFrame, cols: Sequence[str], ordered: bool = True) -> DataFrame:
    """Pairs of different cars of one race, ``i``/``j`` and ``<col>_i``/``<col>_j``.

    A race has one row per car and car numbers are single digits, so a race gives at most 72 pairs.
    The equi join on the race key keeps the work spread over the races.
    """
    left = runners.select(*RACE, F.col("car_no").alias("i"), *[F.col(c).alias(f"{c}_i") for c in cols])
    right = runners.select(*RACE, F.col("car_no").alias("j"), *[F.col(c).alias(f"{c}_j") for c in cols])
    pairs = left.join(right, RACE)
    return pairs.where(F.col("i") != F.col("j")) if ordered else pairs.where(F.col("i") < F.col("j"))


def race_share(df: DataFrame, col: str, name: str) -> DataFrame:
    """``col`` divided by its race total; races with a total of zero or less are left out."""
    w = in_race()
    return (
        df.withColumn("_sum", F.sum(col).over(w)).withColumn("_n", F.count(F.lit(1)).over(w))
        .where((F.col("_sum") > 0) & (F.col("_n") >= 2))
        .withColumn(name, F.col(col) / F.col("_sum")).drop("_sum", "_n")
    )


def harville_pairs(probs: DataFrame, col: str = "p_win") -> DataFrame:
    """First-two probabilities: ``ST2`` ordered, ``SH2`` the sum of both orders."""
    q = race_share(probs.select(*CAR, col), col, "q")
    pairs = field_pairs(q, ["q"], ordered=False)
    qi, qj = F.col("q_i"), F.col("q_j")
    ij = F.when(1 - qi > 0, qi * qj / (1 - qi))
    ji = F.when(1 - qj > 0, qj * qi / (1 - qj))
    zero = F.lit(0.0)
    rows = inline_rows(
        ["bet_type", "kumi_ban", "p_combo"],
        ["ST2", F.concat_ws("-", "i", "j"), ij],
        ["ST2", F.concat_ws("-", "j", "i"), ji],
        ["SH2", F.concat_ws("=", "i", "j"), F.coalesce(ij, zero) + F.coalesce(ji, zero)],
    )
    return pairs.select(*RACE, rows).where(F.col("p_combo").isNotNull())


def combo_mass_check(combos: DataFrame) -> DataFrame:
    """Median and mean over races of the total probability per bet type."""
    mass = combos.groupBy(*MARKET).agg(settle(F.sum("p_combo"), 6).alias("mass"))
    return distribution(mass, ["bet_type"], F.col("mass"), {"median_mass": 0.5}, [mean_value().alias("mean_mass")])
