"""Quality ledgers and monitoring (2.14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paceline.functions.moments import minus_minutes, seconds_between
from paceline.functions.numeric import start_band
from paceline.functions.text import truthy
from paceline.keys import CAPTURE_OFFSETS, CAR, RACE, VENUE_DAY
from paceline.operators.aggregates import daily_counts
from paceline.operators.joins import completion_counts, two_level_default
from paceline.operators.ordered import distributions

# Coverage limits and snapshots per race.
LINES_WARN, SNAPS_WARN, NOTE_BELOW = 0.50, 0.80, 0.95
SNAPS_PER_RACE = len(CAPTURE_OFFSETS)
VOID_REASONS = ["full_refund", "day_canceled"]


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def quality_venue_day(meta: DataFrame, entries: DataFrame, results: DataFrame, payouts: DataFrame) -> DataFrame:
    """Races planned, with results and paid per venue-day, and the first status that applies."""

    def races(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*VENUE_DAY).agg(F.countDistinct("race_no").alias(name))

    out = (
        meta.select(*VENUE_DAY, truthy(F.col("is_canceled")).alias("is_canceled"))
        .join(races(entries, "n_planned"), VENUE_DAY, "left").join(races(results, "n_results"), VENUE_DAY, "left")
        .join(races(payouts, "n_payouts"), VENUE_DAY, "left").fillna(0, ["n_planned", "n_results", "n_payouts"])
    )
    plan, res, pay = F.col("n_planned"), F.col("n_results"), F.col("n_payouts")
    status = (
        F.when(F.col("is_canceled"), "canceled").when(plan == 0, "no_entries").when(res == 0, "all_canceled")
        .when(res < plan, "partial_canceled").when(pay < res, "payout_missing").otherwise("normal")
    )
    return out.withColumns({
        "n_missing": plan - pay,
        "completion": F.when(plan == 0, F.lit(0.0)).otherwise(F.round(pay / plan, 4)),
        "status": status,
    })


def mark_results_missing(quality: DataFrame) -> DataFrame:
    """A day on which every venue (two or more) has no results was not fetched, rather than cancelled."""
    planned = quality.where((F.col("n_planned") > 0) & ~F.col("is_canceled"))
    days = planned.groupBy("race_date").agg(F.count(F.lit(1)).alias("_venues"), F.max("n_results").alias("_most"))
    bad = days.where((F.col("_venues") >= 2) & (F.col("_most") == 0)).select("race_date", F.lit(1).alias("_bad"))
    hit = (F.col("_bad") == 1) & (F.col("status") == "all_canceled")
    return quality.join(bad, "race_date", "left").withColumn(
        "status", F.when(hit, "results_missing").otherwise(F.col("status"))).drop("_bad")


def quality_incremental(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Keep stored days as they are; judge only later days."""
    last = stored.agg(F.max("race_date")).first()[0]
    newer = fresh if last is None else fresh.where(F.col("race_date") > F.lit(last))
    return stored.unionByName(newer)


def completion_race(
    entries: DataFrame, results: DataFrame, payouts: DataFrame, meta: DataFrame, voids: DataFrame
) -> DataFrame:
    """Status per race; cancelled days and recorded voids explain only what is missing."""
    counts = completion_counts(entries, results, payouts)
    rows, done, paid = F.col("n_result_rows"), F.col("n_tyaku"), F.col("has_payout")
    raw = (
        F.when((rows > 0) & (done == 0), "canceled").when(rows == 0, "missing_results")
        .when((done > 0) & (paid == 0), "missing_payout").otherwise("complete")
    )
    off = meta.where(truthy(F.col("is_canceled"))).select(*VENUE_DAY).distinct().withColumn("canceled_day", F.lit(1))
    out = counts.withColumn("_raw", raw).join(off, VENUE_DAY, "left").withColumn(
        "canceled_day", F.coalesce("canceled_day", F.lit(0)))
    out = two_level_default(out, voids, "_reason")
    missing, is_off = F.col("_raw").startswith("missing"), F.col("canceled_day") == 1
    void = missing & ~is_off & F.col("_reason").isNotNull()
    return out.withColumns({
        "status": F.when(missing & (is_off | F.col("_reason").isNotNull()), "canceled").otherwise(F.col("_raw")),
        "void_reason": F.when(void, F.col("_reason")).otherwise(""),
    }).drop("_raw", "_reason")


def completion_missing(completion: DataFrame, start: str, end: str, today: str) -> DataFrame:
    d = F.col("race_date")
    return completion.where(d.between(day(start), day(end)) & (d < day(today)) & F.col("status").startswith("missing"))


def completion_totals(completion: DataFrame) -> DataFrame:
    """Missing races against races explained by a void."""
    return completion.agg(
        F.count(F.lit(1)).alias("n_races"),
        F.count(F.when(F.col("status").startswith("missing"), 1)).alias("n_missing"),
        F.count(F.when(F.col("void_reason") != "", 1)).alias("n_void"))


def _gap_races(entries: DataFrame, lines: DataFrame, start: str, end: str) -> DataFrame:
    inside = F.col("race_date").between(day(start), day(end))
    races = entries.where(inside).groupBy(*RACE).agg(F.min("st_time").alias("st_time"))
    have = lines.where(inside).select(*RACE).distinct().withColumn("_has", F.lit(1))
    return races.join(have, RACE, "left").withColumn("miss", F.col("_has").isNull().cast("long")).drop("_has")


def lines_gap_by_band(entries: DataFrame, lines: DataFrame, start: str, end: str) -> DataFrame:
    """Races without a line-up, by the part of the day in which the venue starts."""
    venue = _gap_races(entries, lines, start, end).groupBy(*VENUE_DAY).agg(
        F.count(F.lit(1)).alias("n"), F.sum("miss").alias("miss"), F.min("st_time").alias("first"))
    return venue.groupBy(start_band(F.col("first")).alias("band")).agg(
        F.sum("n").alias("races"), F.sum("miss").alias("missing_races"), F.count(F.lit(1)).alias("venue_days"),
        F.count(F.when(F.col("miss") > 0, 1)).alias("missing_venue_days"),
        (F.sum("miss") / F.sum("n")).alias("rate"))


def lineup_gap_flag(bands: DataFrame, limit: float = 0.05) -> DataFrame:
    out = bands.agg(F.sum("races").alias("races"), F.sum("missing_races").alias("missing_races"))
    rate = F.coalesce(F.try_divide("missing_races", "races"), F.lit(0.0))
    return out.withColumn("rate", rate).withColumn("flag", F.when(F.col("rate") > limit, "warn").otherwise("ok"))


def result_gaps(entries: DataFrame, results: DataFrame, payouts: DataFrame) -> DataFrame:
    """Races without result rows, and races that finished but have no payout."""
    state = completion_counts(entries, results, payouts)
    gap = F.when(F.col("n_result_rows") == 0, "results_gap").when(
        (F.col("n_tyaku") > 0) & (F.col("has_payout") == 0), "payout_gap")
    return state.withColumn("gap", gap).where(F.col("gap").isNotNull()).select(*RACE, "gap")


def recovery_classify(missing: DataFrame, results: DataFrame, payouts: DataFrame, targets: DataFrame, errors: DataFrame) -> DataFrame:
    """Outcome of a repair run per missing race; races that were not asked for are side effects."""
    res = results.groupBy(*RACE).agg(F.count(F.lit(1)).alias("_rows"), F.count("tyaku").alias("_done"))
    pay = payouts.select(*RACE).distinct().withColumn("_paid", F.lit(1))
    asked = targets.select(*RACE).distinct().withColumn("_asked", F.lit(1))
    broken = errors.select(*VENUE_DAY).distinct().withColumn("_err", F.lit(1))
    df = missing.join(res, RACE, "left").join(pay, RACE, "left").join(asked, RACE, "left").join(broken, VENUE_DAY, "left")
    was_results = F.col("prev_status") == "missing_results"
    outcome = (
        F.when(F.col("_err") == 1, "parse_error")
        .when(was_results & (F.col("_done") > 0), "recovered").when(was_results & (F.col("_rows") > 0), "canceled_confirmed")
        .when(~was_results & (F.col("_paid") == 1), "recovered").otherwise("still_missing")
    )
    return df.select(*RACE, "prev_status", outcome.alias("outcome"), F.when(F.col("_asked") == 1, 0).otherwise(1).alias("is_side_effect"))


def daily_health(tables: dict[str, DataFrame], log: DataFrame, start: str, end: str, today: str) -> DataFrame:
    """Rows per table and day with one status. ``tables`` needs entries, lines, results (and more)."""
    counts = daily_counts({**tables, "snapshots_ok": log.where(F.col("status") == "ok")}, start, end)
    races = tables["entries"].groupBy("race_date").agg(F.countDistinct("place_code", "race_no").alias("n_races"))
    df = counts.join(races, "race_date", "left").fillna(0, ["n_races"])
    lines = F.coalesce(F.try_divide("lines", "entries"), F.lit(1.0))
    snaps = F.coalesce(F.try_divide(F.col("snapshots_ok"), F.col("n_races") * SNAPS_PER_RACE), F.lit(1.0))
    status = (
        F.when(F.col("entries") == 0, "no_data").when(F.col("race_date") == day(today), "in_progress")
        .when(F.col("results") == 0, "results_missing").when(F.col("lines") == 0, "lines_missing")
        .when(F.col("snapshots_ok") == 0, "snapshots_missing").when(lines < LINES_WARN, "lines_warn")
        .when(snaps < SNAPS_WARN, "snapshots_warn")
        .when((lines < NOTE_BELOW) | (snaps < NOTE_BELOW), "ok_with_note").otherwise("ok")
    )
    return df.withColumns({"lines_ratio": lines, "snapshots_ratio": snaps, "status": status})


def overall_status(daily: DataFrame, missing: DataFrame) -> DataFrame:
    """NG with a day without data, WARN with a warning or a missing race, else OK; today is left out."""
    settled = daily.where(F.col("status") != "in_progress")
    ok = F.col("status").isin("ok", "ok_with_note")
    days = settled.agg(
        F.count(F.lit(1)).alias("n_total_days"), F.count(F.when(ok, 1)).alias("n_ok_days"),
        F.count(F.when(F.col("status") == "no_data", 1)).alias("n_nodata"),
        F.count(F.when(~ok & (F.col("status") != "no_data"), 1)).alias("n_warn"))
    gone = missing.agg(F.count(F.lit(1)).alias("n_missing"))
    level = F.when(F.col("n_nodata") > 0, "NG").when((F.col("n_warn") > 0) | (F.col("n_missing") > 0), "WARN").otherwise("OK")
    return days.withColumn("n_missing", gone.scalar()).withColumn("level", level)


def complete_races(completion: DataFrame) -> DataFrame:
    """Keys of the races whose results and payouts are all there."""
    return completion.where(F.col("status") == "complete").select(*RACE)


def capture_timing(timing: DataFrame) -> DataFrame:
    """Completion lag, fetch time and after-start captures of good captures by offset."""
    ok = timing.where(F.col("status") == "ok")
    key = ["target_offset_min"]
    early = F.when(F.col("seconds_before_done") < 0, 1)
    return distributions(
        ok, key, {"row": F.lit(1), "lag": F.abs("done_lag_sec"), "fetch": F.col("fetch_sec"), "done_lag": F.col("done_lag_sec"), "early": early},
        {"done_lag_p95": ("lag", 0.95), "fetch_p95": ("fetch", 0.95)},
        [F.count("lag").alias("n"), F.max("done_lag").alias("done_lag_max"), F.count("early").alias("after_start")])


def lead_summary(log: DataFrame) -> DataFrame:
    """Actual seconds before the start of good captures, by target offset."""
    ok = log.where(F.col("status") == "ok")
    lead = F.col("seconds_before_start") / 60
    return ok.groupBy("target_offset_min").agg(
        F.count(lead).alias("n"), F.avg(lead).alias("mean_lead"), F.coalesce(F.stddev_samp(lead), F.lit(0.0)).alias("std_lead"))


def prediction_completeness(official: DataFrame, expected: DataFrame) -> DataFrame:
    """Per race: expected cars, cars with an official prediction, complete or not."""
    got = official.select(*CAR).distinct().withColumn("_got", F.lit(1))
    return expected.select(*CAR).distinct().join(got, CAR, "left").groupBy(*RACE).agg(
        F.count(F.lit(1)).alias("n_expected"), F.count("_got").alias("n_official")
    ).withColumn("complete", F.col("n_expected") == F.col("n_official"))


def run_type_classify(runs: DataFrame, starts: DataFrame) -> DataFrame:
    """A run is official only if it was made before the first start of its day."""
    first = starts.where(F.col("start_dt").isNotNull()).groupBy("race_date").agg(F.min("start_dt").alias("first_start"))
    out = runs.join(first, "race_date", "left")
    return out.withColumn("run_class", F.when(F.col("predicted_at") < F.col("first_start"), "official").otherwise("rerun"))


def log_rebuild(log: DataFrame, odds: DataFrame) -> DataFrame:
    """Log rows for captures that left prices but no log entry, added to the log."""
    key = [*RACE, "target_offset_min"]
    seen = odds.groupBy(*key).agg(F.max("snapshot_dt").alias("snapshot_dt"), F.count(F.lit(1)).alias("n_rows"))
    lost = seen.join(log.select(*key).distinct(), key, "left_anti").withColumn("status", F.lit("ok")).withColumn("note", F.lit("rebuilt"))
    return log.select(*key, "snapshot_dt", "n_rows", "status", F.lit("").alias("note")).unionByName(lost)


def log_backfill_seconds(log: DataFrame) -> DataFrame:
    """Planned time, seconds before the start and lag from start, offset and capture time."""
    planned = minus_minutes(F.col("start_dt"), F.col("target_offset_min"))
    return log.withColumns({
        "scheduled": planned,
        "before_start": seconds_between(F.col("start_dt"), F.col("snapshot_dt")),
        "lag": seconds_between(F.col("snapshot_dt"), planned),
    })


def recent_gaps(gaps: DataFrame, today: str, days: int = 60) -> DataFrame:
    return gaps.where(F.col("race_date") >= F.date_sub(day(today), days))


def observation_stage(ok_races: DataFrame) -> DataFrame:
    n = F.col("n_races")
    return ok_races.withColumn("stage", F.when(n < 30, "accumulate").when(n < 50, "audit").otherwise("enough"))


def backfill_todo(quality: DataFrame, done: DataFrame, keys: Sequence[str] = VENUE_DAY) -> DataFrame:
    return quality.where(F.col("status") == "normal").select(*keys).join(done.select(*keys).distinct(), list(keys), "left_anti")
