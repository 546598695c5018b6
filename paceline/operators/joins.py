"""Joins on race and combination keys (2.3) and set operations (2.7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from paceline.keys import CAR, RACE, VENUE_DAY
from paceline.operators.dedup import newest_per_key


def normalise_keys(df: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Cast key columns to one type before a join."""
    return df.withColumns({k: F.col(k).cast("string").try_cast(t) for k, t in keys.items()})


def completion_counts(entries: DataFrame, results: DataFrame, payouts: DataFrame) -> DataFrame:
    """Entries, result rows, finishes and payouts per race; a race in any source is kept.

    Each side is reduced to one row per race before the full joins.
    """
    exp = entries.groupBy(*RACE).agg(F.countDistinct("car_no").alias("n_entries"))
    res = results.groupBy(*RACE).agg(F.count(F.lit(1)).alias("n_result_rows"), F.count("tyaku").alias("n_tyaku"))
    pay = payouts.groupBy(*RACE).agg(F.lit(1).cast("long").alias("has_payout"))
    out = exp.join(res, RACE, "full").join(pay, RACE, "full")
    return out.fillna(0, ["n_entries", "n_result_rows", "n_tyaku", "has_payout"])


def two_level_default(df: DataFrame, reasons: DataFrame, name: str = "reason") -> DataFrame:
    """Race-level reason if there is one, else the reason of the whole venue-day (blank race)."""
    by_race = reasons.where(F.col("race_no").isNotNull()).groupBy(*RACE).agg(F.max("reason").alias("_race_reason"))
    by_day = reasons.where(F.col("race_no").isNull()).groupBy(*VENUE_DAY).agg(F.max("reason").alias("_day_reason"))
    out = df.join(by_race, RACE, "left").join(by_day, VENUE_DAY, "left")
    return out.withColumn(name, F.coalesce("_race_reason", "_day_reason")).drop("_race_reason", "_day_reason")


def keep_races(df: DataFrame, races: DataFrame) -> DataFrame:
    return df.join(races.select(*RACE), RACE, "left_semi")


def drop_races(df: DataFrame, races: DataFrame) -> DataFrame:
    return df.join(races.select(*RACE), RACE, "left_anti")


def common_races(a: DataFrame, z: DataFrame) -> DataFrame:
    return a.select(*RACE).intersect(z.select(*RACE))


def overlap_count(a: DataFrame, z: DataFrame) -> DataFrame:
    """Races of each source and of both, from one aggregation over the stacked keys."""
    marked = a.select(*RACE, F.lit(1).alias("_a"), F.lit(0).alias("_z")).unionByName(
        z.select(*RACE, F.lit(0).alias("_a"), F.lit(1).alias("_z")))
    per_race = marked.groupBy(*RACE).agg(F.max("_a").alias("a"), F.max("_z").alias("z"))
    return per_race.agg(
        F.sum("a").alias("n_left"), F.sum("z").alias("n_right"), F.sum(F.col("a") * F.col("z")).alias("n_both"))


def at_offset(odds: DataFrame, bet: str, offset: float, ties: Sequence[str]) -> DataFrame:
    """The price list at one capture offset, the latest snapshot where it repeats."""
    rows = odds.where((F.col("bet_type") == bet) & (F.col("target_offset_min") == offset) & (F.col("odds") > 0))
    return newest_per_key(rows, [*RACE, "kumi_ban"], [F.col("snapshot_dt"), *[F.col(t) for t in ties]], ["odds"])


def minutes_from_start(quotes: DataFrame, starts: DataFrame) -> DataFrame:
    """Whole minutes from the race start to each quote (negative = before)."""
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return quotes.join(starts.select(*RACE, "start_dt"), RACE, "left").withColumn(
        "delta_min", F.floor((us("snapshot_dt") - us("start_dt")) / 60000000))


def pair_overlap(guess: DataFrame, truth: DataFrame) -> DataFrame:
    """Same-group pairs: how many guessed, true and correct, with precision and recall.

    Both frames have one row per (race, car) with a ``group``; a race has at most 36 pairs.
    """

    def pairs(df: DataFrame) -> DataFrame:
        a = df.select(*RACE, "group", F.col("car_no").alias("i"))
        z = df.select(*RACE, "group", F.col("car_no").alias("j"))
        return a.join(z, [*RACE, "group"]).where("i < j").select(*RACE, "i", "j")

    marked = pairs(guess).withColumn("side", F.lit(1)).unionByName(pairs(truth).withColumn("side", F.lit(2)))
    both = marked.groupBy(*RACE, "i", "j").agg(F.sum("side").alias("s"))
    per_race = both.groupBy(*RACE).agg(
        F.count(F.when(F.col("s") != 2, 1)).alias("p"), F.count(F.when(F.col("s") >= 2, 1)).alias("t"),
        F.count(F.when(F.col("s") == 3, 1)).alias("c"))
    n_races = truth.select(*RACE).distinct().agg(F.count(F.lit(1)).alias("n_races"))
    total = per_race.agg(
        F.sum("p").alias("n_pred"), F.sum("t").alias("n_true"), F.sum("c").alias("n_correct"),
        F.count(F.when((F.col("p") != F.col("c")) | (F.col("t") != F.col("c")), 1)).alias("_not_exact"),
        F.count(F.when(F.col("c") > 0, 1)).alias("races_with_hit"))
    out = total.withColumn("n_races", n_races.scalar())
    return out.select(
        "n_races", "n_pred", "n_true", "n_correct", "races_with_hit",
        (F.col("n_races") - F.col("_not_exact")).alias("n_exact"),
        F.try_divide("n_correct", "n_pred").alias("precision"), F.try_divide("n_correct", "n_true").alias("recall"))


def missing_keys(expected: DataFrame, actual: DataFrame, keys: Sequence[str] = CAR) -> DataFrame:
    """Expected keys without a row; no rows means complete."""
    return expected.select(*keys).distinct().join(actual.select(*keys), list(keys), "left_anti")


def backfill_plan(meta: DataFrame, completion: DataFrame, today: str, lookback: int, target: str) -> DataFrame:
    """Days to fetch again: ``place_code`` NULL = every venue (no rows at all), else the venues to repair."""
    day = F.lit(today).cast("date")
    days = meta.sparkSession.range(1).select(
        F.explode(F.sequence(F.date_sub(day, lookback), F.date_sub(day, 2))).alias("race_date")
    ).where(F.col("race_date") != F.lit(target).cast("date"))
    seen = meta.select("race_date").distinct()
    whole = days.join(seen, "race_date", "left_anti").select("race_date", F.lit(None).cast("int").alias("place_code"))
    broken = completion.where(F.col("status").startswith("missing")).select("race_date", "place_code").distinct()
    some = broken.join(days.join(seen, "race_date", "left_semi"), "race_date", "left_semi").select("race_date", "place_code")
    return whole.unionByName(some.withColumn("place_code", F.col("place_code").cast("int")))
