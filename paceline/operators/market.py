"""Prices to probabilities, expected value and the gap between price and settlement (2.10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paceline.functions.numeric import band, delay_bin, settle
from paceline.functions.text import car_at
from paceline.keys import CAR, COMBO, MARKET, RACE, in_race
from paceline.operators.ordered import distribution, mean_value, n_values, share

# Left-closed price bands, the verdict limits and the smallest field.
BAND_EDGES = [1.0, 3.0, 6.0, 10.0, 20.0, 50.0, 1e9]
BAND_LABELS = ["1-3", "3-6", "6-10", "10-20", "20-50", "50-+"]
MEDIAN_LIMIT_PCT, ADVERSE_LIMIT_PCT = 3.0, 10.0
MIN_FIELD = 5

# Distributions are counted at six digits: the report needs four, and equal values combine before
# the shuffle.


def _both_cars(odds: DataFrame, bet: str) -> DataFrame:
    """One row per combination and car in it: ``car_no``, ``side`` 0/1, ``inv`` = 1/odds."""
    live = odds.where((F.col("bet_type") == bet) & (F.col("odds").try_cast("double") > 0))
    cars = live.select(
        *RACE, (1 / F.col("odds")).alias("inv"), car_at(F.col("kumi_ban"), 1).alias("a"), car_at(F.col("kumi_ban"), 2).alias("z")
    ).where(F.col("a").isNotNull() & F.col("z").isNotNull())
    return cars.select(*RACE, "inv", F.posexplode(F.array("a", "z")).alias("side", "car_no"))


def devig_first_marginal(odds: DataFrame, complete: bool = True) -> DataFrame:
    """Win probability per car from ordered pairs: normalised inverse prices, summed by first car.

    ``complete`` keeps only races with all n(n-1) prices and at least five cars.
    """
    first = F.col("side") == 0
    per_car = _both_cars(odds, "ST2").groupBy(*CAR).agg(
        F.sum(F.when(first, F.col("inv"))).alias("m"), F.count(F.when(first, 1)).alias("k")
    )
    n = F.count(F.lit(1)).over(in_race())
    rows = per_car.withColumns({"n": n, "tickets": F.sum("k").over(in_race()), "total": F.sum("m").over(in_race())})
    if complete:
        rows = rows.where((F.col("n") >= MIN_FIELD) & (F.col("tickets") == F.col("n") * (F.col("n") - 1)))
    return rows.where(F.col("k") > 0).select(*CAR, (F.col("m") / F.col("total")).alias("mkt_win"))


def devig_contains_marginal(odds: DataFrame) -> DataFrame:
    """Top-two probability per car from unordered pairs; adds up to two in a complete race."""
    per_car = _both_cars(odds, "SH2").groupBy(*CAR).agg(F.sum("inv").alias("m"), F.count(F.lit(1)).alias("k"))
    rows = per_car.withColumns({
        "n": F.count(F.lit(1)).over(in_race()), "seats": F.sum("k").over(in_race()), "total": F.sum("m").over(in_race()) / 2,
    })
    full = (F.col("n") >= MIN_FIELD) & (F.col("seats") == F.col("n") * (F.col("n") - 1))
    return rows.where(full).select(*CAR, (F.col("m") / F.col("total")).alias("mkt_top2"))


def _winners(paid: DataFrame) -> DataFrame:
    """Winners are a handful per race, prices a multiple: each partition's are hashed, and the prices are not sorted."""
    return paid.hint("shuffle_hash")


def join_ev(combos: DataFrame, odds: DataFrame) -> DataFrame:
    """Combination probability times price."""
    return combos.join(odds, COMBO).withColumn("ev", F.col("p_combo") * F.col("odds"))


def ev_summary(priced: DataFrame) -> DataFrame:
    return distribution(
        priced, ["bet_type"], settle(F.col("ev"), 6), {"ev_median": 0.5},
        [n_values().alias("n"), mean_value().alias("ev_mean"), share(F.col("v") > 1).alias("share_above_1")],
    )


def overround(odds: DataFrame) -> DataFrame:
    """Median and mean of the inverse price total per race and bet type, with the implied takeout."""
    per_race = odds.where(F.col("odds") > 0).groupBy(*MARKET).agg(F.sum(1 / F.col("odds")).alias("ov"))
    out = distribution(
        per_race, ["bet_type"], settle(F.col("ov"), 6), {"overround_median": 0.5},
        [n_values().alias("n_races"), mean_value().alias("overround_mean")],
    )
    return out.withColumn("implied_takeout_pct", (1 - 1 / F.col("overround_median")) * 100)


def allbuy_roi(odds: DataFrame, payouts: DataFrame) -> DataFrame:
    """Return of buying every combination, with equal stakes and with stakes in proportion to 1/odds."""
    hit = odds.join(_winners(payouts.select(*COMBO, "payout")), COMBO, "left")
    inverse = 1 / F.col("odds")
    per_race = hit.groupBy(*MARKET).agg(
        F.count(F.lit(1)).alias("n_combos"),
        (F.sum(inverse * F.coalesce("payout", F.lit(0)) / 100) / F.sum(inverse)).alias("pool_ret"),
    )
    wins = payouts.groupBy(*MARKET).agg(F.sum("payout").alias("win_payout"))
    return per_race.join(wins, MARKET, "left").groupBy("bet_type").agg(
        F.count(F.lit(1)).alias("n_races"),
        F.avg("n_combos").alias("avg_n_combos"),
        ((F.sum(F.coalesce("win_payout", F.lit(0))) / (F.sum("n_combos") * 100) - 1) * 100).alias("uniform_roi_pct"),
        ((F.sum("pool_ret") / F.count(F.lit(1)) - 1) * 100).alias("pool_roi_pct"),
    )


def settlement_wedge(snaps: DataFrame, payouts: DataFrame) -> DataFrame:
    """Winning combinations only: realised odds against the snapshot (W: middle of its range)."""
    won = snaps.where(F.col("odds") > 0).join(
        _winners(payouts.select(*COMBO, (F.col("payout") / 100).alias("realized_odds"))), COMBO
    )
    middle = F.coalesce((F.col("odds") + F.col("max_odds")) / 2, F.col("odds"))
    basis = F.when(F.col("bet_type") == "W", middle).otherwise(F.col("odds"))
    return won.withColumn("snap_basis", basis).withColumn("wedge", F.col("realized_odds") / F.col("snap_basis") - 1)


def wedge_by_bet_offset(wedges: DataFrame) -> DataFrame:
    v = F.col("v")
    out = distribution(
        wedges, ["bet_type", "target_offset_min"], settle(F.col("wedge"), 6), {"median_wedge": 0.5, "p25": 0.25, "p75": 0.75},
        [n_values().alias("n"), mean_value().alias("mean_wedge"), share(F.abs(v) > 0.10).alias("frac_abs_gt10"),
         share(F.abs(v) > 0.20).alias("frac_abs_gt20"), share(v < 0).alias("frac_adverse")],
    )
    pct = ["median_wedge", "mean_wedge", "p25", "p75", "frac_abs_gt10", "frac_abs_gt20", "frac_adverse"]
    return out.select("bet_type", "target_offset_min", "n", *[(F.col(c) * 100).alias(f"{c}_pct") for c in pct])


def at_widest_offset(wedges: DataFrame) -> DataFrame:
    """Rows of the earliest capture; the offset is one of a handful of fixed values."""
    widest = wedges.agg(F.max("target_offset_min")).first()[0]
    return wedges.where(F.col("target_offset_min") == F.lit(widest))


def wedge_by_odds_band(wedges: DataFrame) -> DataFrame:
    banded = at_widest_offset(wedges).withColumn("odds_band", band(F.col("snap_basis"), BAND_EDGES, BAND_LABELS))
    out = distribution(
        banded.where(F.col("odds_band").isNotNull()), ["odds_band"], settle(F.col("wedge"), 6), {"median_wedge": 0.5},
        [n_values().alias("n"), share(F.col("v") < 0).alias("adverse")],
    )
    return out.select("odds_band", "n", (F.col("median_wedge") * 100).alias("median_wedge_pct"), (F.col("adverse") * 100).alias("adverse_pct"))


def range_containment(wedges: DataFrame) -> DataFrame:
    ranged = wedges.where((F.col("bet_type") == "W") & F.col("max_odds").isNotNull())
    low, real, high = F.col("odds"), F.col("realized_odds"), F.col("max_odds")
    return ranged.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(real.between(low, high).cast("int")).alias("in_range"),
        F.avg((real < low).cast("int")).alias("below_range"),
    )


def wedge_verdict(wedges: DataFrame) -> DataFrame:
    out = distribution(
        at_widest_offset(wedges), ["target_offset_min"], settle(F.col("wedge"), 6), {"m": 0.5},
        [n_values().alias("n"), share(F.col("v") < 0).alias("a")],
    )
    med, adv = F.col("m") * 100, F.col("a") * 100
    ok = (F.abs(med) < MEDIAN_LIMIT_PCT) & (F.abs(adv - 50) < ADVERSE_LIMIT_PCT)
    return out.select("target_offset_min", "n", med.alias("median_pct"), adv.alias("adverse_pct"),
                      F.when(ok, "pass").otherwise("caution").alias("verdict"))


def drift_by_offset(snaps: DataFrame, payouts: DataFrame) -> DataFrame:
    """Price drift in percent from the snapshot to the final odds, per offset and bet type."""
    won = snaps.where(F.col("odds") > 0).join(_winners(payouts.where(F.col("payout") > 0).select(*COMBO, "payout")), COMBO)
    drift = settle((F.col("payout") / 100 / F.col("odds") - 1) * 100, 6)
    out = distribution(
        won, ["target_offset_min", "bet_type"], drift, {"drift_med": 0.5, "drift_p25": 0.25, "drift_p75": 0.75},
        [n_values().alias("n"), share(F.col("v") < -5).alias("worse")],
    )
    return out.withColumn("worse_pct", F.col("worse") * 100).drop("worse")


def official_lead_bins(quotes: DataFrame) -> DataFrame:
    """Delay of the official time against the start, for races with exactly one official time."""
    per_race = quotes.groupBy(*RACE).agg(
        F.min("official_dt").alias("lo"), F.max("official_dt").alias("hi"), F.min("start_dt").alias("start_dt")
    )
    one = per_race.where((F.col("lo") == F.col("hi")) & F.col("start_dt").isNotNull())
    seconds = F.unix_micros(F.col("lo").cast("timestamp")) - F.unix_micros(F.col("start_dt").cast("timestamp"))
    return one.groupBy(delay_bin(F.floor(seconds / 60000000)).alias("delay")).agg(F.count(F.lit(1)).alias("n_races"))


def health(snaps: DataFrame, payouts: DataFrame) -> DataFrame:
    """Weekly market health: wedge per bet and offset, without W whose price is a range."""
    wedges = settlement_wedge(snaps.where(F.col("bet_type") != "W"), payouts)
    races = wedges.groupBy("bet_type", "target_offset_min").agg(F.countDistinct(*RACE).alias("n_races"))
    profile = wedge_by_bet_offset(wedges).select(
        "bet_type", "target_offset_min", F.col("median_wedge_pct").alias("median_pct"),
        F.col("frac_abs_gt10_pct").alias("gt10_pct"), F.col("frac_adverse_pct").alias("adverse_pct"))
    return races.join(profile, ["bet_type", "target_offset_min"])


def overround_flag(ov: DataFrame) -> DataFrame:
    """Flag bet types whose median overround is outside 1.25..1.45."""
    return ov.withColumn("flagged", ~F.col("overround_median").between(1.25, 1.45))
