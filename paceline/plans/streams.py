"""Capture planning and streams (2.15): the driver files as a feed, processed until drained."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.functions.moments import start_ts
from paceline.keys import CAPTURE_OFFSETS, COMBO, RACE, VENUE_DAY
from paceline.plans import bindings as b
from paceline.plans.quality import LINES, known_lines
from paceline.plans.registry import query
from paceline.session import scratch_path
from paceline.streaming import capture as cs

R = "race_date, place_code, race_no"


def feed(spark, sf, name):
    return cs.file_stream(spark, sf, name, b.table(spark, sf, name).schema)


def snap_feed(spark, sf):
    rows = b.snapshot_rows(b.raw_lines(spark, sf, feed(spark, sf, "lineitem")))
    return rows.withColumn("event_time", F.col("snapshot_dt").cast("timestamp"))


def log_feed(spark, sf):
    rows = b.capture_rows(spark, sf, b.raw_lines(spark, sf, feed(spark, sf, "lineitem")))
    return rows.withColumn("event_time", F.col("snapshot_dt").cast("timestamp"))


def starts(spark, sf):
    return b.races(spark, sf).select(*RACE, start_ts(F.col("race_date"), F.col("st_time")).alias("start_dt"))


START = "CAST(concat(strftime(race_date, '%Y-%m-%d'), ' ', st_time, ':00') AS TIMESTAMP)"


@query("plan_captures", f"""
SELECT {R}, off AS target_offset_min, due FROM (SELECT {R}, off, {START} - to_microseconds(CAST(off * 60000000 AS BIGINT)) AS due FROM races,
  (VALUES (5.0::DOUBLE), (3.0), (2.0), (1.0), (0.5)) o(off)) p WHERE due > TIMESTAMP '2000-06-01 11:58:00' AND NOT EXISTS (
  SELECT 1 FROM capture_log c WHERE c.status = 'ok' AND c.race_no = p.race_no AND c.target_offset_min = p.off)""",
       dbl="target_offset_min", dt="race_date", ts="due")
def _(spark, sf):
    done = b.capture_log(spark, sf).where(F.col("status") == "ok")
    now = F.lit("2000-06-01 12:00:00").cast("timestamp_ntz")
    return cs.plan_captures(starts(spark, sf), done, now).select(*RACE, "target_offset_min", "due")


@query("plan_lineup_checks", f"""
WITH first AS (SELECT race_date, place_code, min({START}) AS f, CAST(race_date AS TIMESTAMP) + INTERVAL 12 HOUR AS now FROM races
  WHERE race_no NOT IN (SELECT race_no FROM known_lines) AND {START} > CAST(race_date AS TIMESTAMP) + INTERVAL 12 HOUR GROUP BY 1, 2),
dues AS (SELECT DISTINCT race_date, place_code, greatest(f - to_minutes(m), now) AS due FROM first, (VALUES (120), (60), (30), (10)) l(m))
SELECT race_date, place_code, due, due = max(due) OVER (PARTITION BY race_date, place_code) AS last FROM dues""",
       dt="race_date", ts="due", ctes=LINES)
def _(spark, sf):
    noon = F.col("race_date").cast("timestamp_ntz") + F.expr("interval 12 hours")
    return cs.plan_lineup_checks(starts(spark, sf), known_lines(spark, sf), noon)


@query("stream_ingest_odds", f"SELECT {R}, bet_type, kumi_ban, odds, strftime(race_date, '%Y-%m') AS race_month FROM snapshots", dbl="odds", dt="race_date")
def _(spark, sf):
    path = scratch_path(spark, "months")
    cs.run_available(cs.ingest_odds(snap_feed(spark, sf).drop("event_time"), path), spark)
    return spark.read.option("basePath", path).parquet(path).select(*COMBO, "odds", F.col("race_month").cast("string").alias("race_month"))


@query("stream_dedup", f"SELECT DISTINCT {R}, target_offset_min FROM capture_log", dbl="target_offset_min", dt="race_date")
def _(spark, sf):
    path = scratch_path(spark, "dedup")
    cs.run_available(cs.to_files(cs.dedup_captures(log_feed(spark, sf).select(*RACE, "target_offset_min", "event_time")), path), spark)
    return spark.read.parquet(path).select(*RACE, "target_offset_min")


@query("stream_latest_price", f"SELECT {R}, bet_type, kumi_ban, odds, snapshot_dt FROM latest_odds", dbl="odds", dt="race_date", ts="snapshot_dt")
def _(spark, sf):
    path = scratch_path(spark, "latest")
    cs.run_available(cs.write_latest_price(snap_feed(spark, sf), path), spark)
    return cs.latest_price(spark, path, b.SNAP_TIES)


@query("stream_overround", f"""
SELECT CAST(snapshot_dt AS TIMESTAMP) AS window_start, {R}, sum(1 / odds) AS overround, count(*) AS n FROM snapshots WHERE odds > 0
AND snapshot_dt + INTERVAL 1 MINUTE <= (SELECT max(snapshot_dt) FROM snapshots WHERE odds > 0) - INTERVAL 5 MINUTE GROUP BY ALL""",
       dbl="overround", dt="race_date", ts="window_start")
def _(spark, sf):
    path = scratch_path(spark, "overround")
    cs.run_available(cs.to_files(cs.overround_windows(snap_feed(spark, sf)), path), spark)
    return spark.read.parquet(path)


@query("stream_capture_health", """
WITH a AS (SELECT ts, ([5.0::DOUBLE, 3.0, 2.0, 1.0, 0.5])[user_id % 5 + 1] AS off, CASE event_type WHEN 'error' THEN 'fail' WHEN 'view' THEN 'no_odds' ELSE 'ok' END AS status,
  value FROM events),
w AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(s) AS window_start FROM a, (VALUES (0), (5)) x(s))
SELECT window_start, off AS target_offset_min, count(*) FILTER (status = 'ok') AS n_ok, count(*) FILTER (status = 'no_odds') AS n_no_odds,
  count(*) FILTER (status = 'fail') AS n_fail, avg(value) AS mean_lag FROM w
WHERE window_start + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY 1, 2""",
       dbl="target_offset_min mean_lag", ts="window_start")
def _(spark, sf):
    offsets = F.array(*[F.lit(o) for o in CAPTURE_OFFSETS])
    attempts = feed(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("event_time"), F.element_at(offsets, (F.col("user_id") % 5 + 1).cast("int")).alias("target_offset_min"),
        F.when(F.col("event_type") == "error", "fail").when(F.col("event_type") == "view", "no_odds").otherwise("ok").alias("status"),
        F.col("value").alias("lag_sec"))
    path = scratch_path(spark, "health")
    cs.run_available(cs.to_files(cs.capture_health(attempts), path), spark)
    return spark.read.parquet(path)


@query("stream_late_rows", f"SELECT {R}, car_no, target_offset_min, seconds_before_start, 'late' AS side FROM capture_log WHERE seconds_before_start < 0",
       dbl="target_offset_min seconds_before_start", dt="race_date")
def _(spark, sf):
    path = scratch_path(spark, "sides")
    cs.run_available(cs.split_late(log_feed(spark, sf), path), spark)
    late = spark.read.parquet(path).where(F.col("side") == "late")
    return late.select(*RACE, "car_no", "target_offset_min", "seconds_before_start", F.col("side").cast("string").alias("side"))


@query("stream_join_schedule", """
SELECT race_date, place_code, race_no, target_offset_min, action, count(*) AS n, any_value(due) AS due FROM (
  SELECT c.race_date, c.place_code, c.race_no, target_offset_min, CASE WHEN status_r = 'P' THEN 'dropped' WHEN priority = '1-URGENT' THEN 'moved' ELSE 'kept' END AS action,
    CASE WHEN status_r <> 'P' THEN start_dt + CASE WHEN priority = '1-URGENT' THEN INTERVAL 10 MINUTE ELSE INTERVAL 0 MINUTE END
      - to_microseconds(CAST(target_offset_min * 60000000 AS BIGINT)) END AS due
  FROM capture_log c JOIN (SELECT race_no, status AS status_r, priority FROM races) r ON c.race_no = r.race_no) GROUP BY 1, 2, 3, 4, 5""",
       dbl="target_offset_min", dt="race_date", ts="due")
def _(spark, sf):
    start = start_ts(F.col("race_date"), F.col("st_time"))
    moved = F.when(F.col("priority") == "1-URGENT", start + F.expr("interval 10 minutes")).otherwise(start)
    program = b.races(spark, sf).where(F.col("status") != "P").select(*RACE, moved.alias("start_dt"))
    path = scratch_path(spark, "schedule")
    planned = log_feed(spark, sf).select(*RACE, "target_offset_min", "start_dt")
    cs.run_available(cs.to_files(cs.reschedule(planned, program), path), spark)
    return spark.read.parquet(path).groupBy(*RACE, "target_offset_min", "action").agg(F.count(F.lit(1)).alias("n"), F.max("due").alias("due"))
