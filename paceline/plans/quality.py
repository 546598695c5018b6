"""Quality ledgers and monitoring (2.14) over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.keys import CAR, RACE, VENUE_DAY
from paceline.operators import aggregates as ag, joins as jo, quality as qa
from paceline.operators.dedup import select_official
from paceline.plans import bindings as b
from paceline.plans.registry import query

R = "race_date, place_code, race_no"
TODAY = "2001-08-01"
FROM, TO = "2001-05-01", "2001-08-01"

QUALITY = {
    "venue_quality": """SELECT race_date, place_code, is_canceled = 'True' AS is_canceled, coalesce(n_planned, 0) AS n_planned,
      coalesce(n_results, 0) AS n_results, coalesce(n_payouts, 0) AS n_payouts FROM meta
      LEFT JOIN (SELECT race_date, place_code, count(DISTINCT race_no) AS n_planned FROM runners GROUP BY 1, 2) USING (race_date, place_code)
      LEFT JOIN (SELECT race_date, place_code, count(DISTINCT race_no) AS n_results FROM results GROUP BY 1, 2) USING (race_date, place_code)
      LEFT JOIN (SELECT race_date, place_code, count(DISTINCT race_no) AS n_payouts FROM payouts GROUP BY 1, 2) USING (race_date, place_code)""",
    "quality": """SELECT *, n_planned - n_payouts AS n_missing, CASE WHEN n_planned = 0 THEN 0 ELSE round(n_payouts / n_planned, 4) END AS completion,
      CASE WHEN is_canceled THEN 'canceled' WHEN n_planned = 0 THEN 'no_entries' WHEN n_results = 0 THEN 'all_canceled'
        WHEN n_results < n_planned THEN 'partial_canceled' WHEN n_payouts < n_results THEN 'payout_missing' ELSE 'normal' END AS status
      FROM venue_quality""",
}
COMPLETION = {
    "counts": """SELECT race_date, place_code, race_no, coalesce(n_entries, 0) AS n_entries, coalesce(n_result_rows, 0) AS n_result_rows,
      coalesce(n_tyaku, 0) AS n_tyaku, coalesce(has_payout, 0) AS has_payout FROM
      (SELECT race_date, place_code, race_no, count(DISTINCT car_no) AS n_entries FROM runners GROUP BY ALL) FULL JOIN
      (SELECT race_date, place_code, race_no, count(*) AS n_result_rows, count(tyaku) AS n_tyaku FROM results GROUP BY ALL)
        USING (race_date, place_code, race_no) FULL JOIN
      (SELECT DISTINCT race_date, place_code, race_no, 1::BIGINT AS has_payout FROM payouts) USING (race_date, place_code, race_no)""",
    "completion": """SELECT c.*, coalesce(off, 0) AS canceled_day, raw, coalesce(vr.reason, vd.reason) AS reason,
      CASE WHEN raw LIKE 'missing%' AND (coalesce(off, 0) = 1 OR coalesce(vr.reason, vd.reason) IS NOT NULL) THEN 'canceled' ELSE raw END AS status,
      CASE WHEN raw LIKE 'missing%' AND coalesce(off, 0) = 0 THEN coalesce(vr.reason, vd.reason, '') ELSE '' END AS void_reason
      FROM (SELECT *, CASE WHEN n_result_rows > 0 AND n_tyaku = 0 THEN 'canceled' WHEN n_result_rows = 0 THEN 'missing_results'
        WHEN n_tyaku > 0 AND has_payout = 0 THEN 'missing_payout' ELSE 'complete' END AS raw FROM counts) c
      LEFT JOIN (SELECT race_date, place_code, 1 AS off FROM meta WHERE is_canceled = 'True') m
        ON c.race_date = m.race_date AND c.place_code = m.place_code
      LEFT JOIN (SELECT race_date, place_code, race_no, max(reason) AS reason FROM voids WHERE race_no IS NOT NULL GROUP BY ALL) vr
        ON c.race_date = vr.race_date AND c.place_code = vr.place_code AND c.race_no = vr.race_no
      LEFT JOIN (SELECT race_date, place_code, max(reason) AS reason FROM voids WHERE race_no IS NULL GROUP BY ALL) vd
        ON c.race_date = vd.race_date AND c.place_code = vd.place_code""",
}
# Line-ups are known for the races of the first two customer segments only.
LINES = {
    "known_lines": "SELECT n.* FROM narabi n JOIN races r ON n.race_no = r.race_no WHERE segment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY')",
    "gap_races": f"""SELECT {R}, min(st_time) AS st_time, max(CASE WHEN race_no IN (SELECT race_no FROM known_lines) THEN 0 ELSE 1 END) AS miss
      FROM runners GROUP BY ALL""",
    "gap_bands": """SELECT CASE WHEN h < 10 THEN 'morning' WHEN h < 15 THEN 'day' WHEN h < 20 THEN 'night' ELSE 'midnight' END AS band,
      CAST(sum(n) AS BIGINT) AS races, CAST(sum(miss) AS BIGINT) AS missing_races, count(*) AS venue_days,
      count(*) FILTER (miss > 0) AS missing_venue_days, sum(miss) / sum(n) AS rate FROM (
      SELECT race_date, place_code, count(*) AS n, sum(miss) AS miss, CAST(substr(min(st_time), 1, 2) AS INT) AS h FROM gap_races GROUP BY 1, 2)
      GROUP BY 1""",
}
HEALTH = {
    **LINES,
    "days": f"SELECT CAST(unnest(range(DATE '{FROM}', DATE '{TO}' + 1, INTERVAL 1 DAY)) AS DATE) AS race_date",
    "health": """SELECT race_date, coalesce(venues, 0) AS venues, coalesce(entries, 0) AS entries, coalesce(lines, 0) AS lines,
      coalesce(results_n, 0) AS results, coalesce(payouts_n, 0) AS payouts, coalesce(snapshots_ok, 0) AS snapshots_ok, coalesce(n_races, 0) AS n_races
      FROM days LEFT JOIN (SELECT race_date, count(*) AS venues FROM meta GROUP BY 1) USING (race_date)
      LEFT JOIN (SELECT race_date, count(*) AS entries, count(DISTINCT race_no) AS n_races FROM runners GROUP BY 1) USING (race_date)
      LEFT JOIN (SELECT race_date, count(*) AS lines FROM known_lines GROUP BY 1) USING (race_date)
      LEFT JOIN (SELECT race_date, count(*) AS results_n FROM results GROUP BY 1) USING (race_date)
      LEFT JOIN (SELECT race_date, count(*) AS payouts_n FROM payouts GROUP BY 1) USING (race_date)
      LEFT JOIN (SELECT race_date, count(*) AS snapshots_ok FROM capture_log WHERE status = 'ok' GROUP BY 1) USING (race_date)""",
    "daily": f"""SELECT *, CASE WHEN entries = 0 THEN 'no_data' WHEN race_date = DATE '{TODAY}' THEN 'in_progress' WHEN results = 0 THEN 'results_missing'
      WHEN lines = 0 THEN 'lines_missing' WHEN snapshots_ok = 0 THEN 'snapshots_missing' WHEN lines_ratio < 0.5 THEN 'lines_warn'
      WHEN snapshots_ratio < 0.8 THEN 'snapshots_warn' WHEN lines_ratio < 0.95 OR snapshots_ratio < 0.95 THEN 'ok_with_note' ELSE 'ok' END AS status
      FROM (SELECT *, CASE WHEN entries = 0 THEN 1 ELSE lines / entries END AS lines_ratio,
        CASE WHEN n_races = 0 THEN 1 ELSE snapshots_ok / (n_races * 5) END AS snapshots_ratio FROM health)""",
}


def quality(spark, sf):
    return qa.quality_venue_day(b.meta(spark, sf), b.runners(spark, sf), b.results(spark, sf), b.payouts(spark, sf))


def completion(spark, sf):
    return qa.completion_race(b.runners(spark, sf), b.results(spark, sf), b.payouts(spark, sf), b.meta(spark, sf), b.voids(spark, sf))


def known_lines(spark, sf):
    some = b.races(spark, sf).where(F.col("segment").isin("AUTOMOBILE", "BUILDING", "MACHINERY")).select(*RACE)
    return b.narabi(spark, sf).join(some, RACE, "left_semi")


def health(spark, sf):
    tables = {"venues": b.meta(spark, sf), "entries": b.runners(spark, sf), "lines": known_lines(spark, sf),
              "results": b.results(spark, sf), "payouts": b.payouts(spark, sf)}
    return qa.daily_health(tables, b.capture_log(spark, sf), FROM, TO, TODAY)


@query("quality_venue_day", "SELECT * FROM quality", dbl="completion", dt="race_date", ctes=QUALITY)
def _(spark, sf):
    return quality(spark, sf)


@query("quality_results_missing", """
SELECT q.race_date, place_code, n_planned, n_results, CASE WHEN bad.race_date IS NOT NULL AND status = 'all_canceled' THEN 'results_missing' ELSE status END AS status
FROM quality q LEFT JOIN (SELECT race_date FROM quality WHERE n_planned > 0 AND NOT is_canceled GROUP BY 1 HAVING count(*) >= 2 AND max(n_results) = 0) bad
  ON q.race_date = bad.race_date""", dt="race_date", ctes=QUALITY)
def _(spark, sf):
    return qa.mark_results_missing(quality(spark, sf)).select(*VENUE_DAY, "n_planned", "n_results", "status")


@query("quality_incremental", """
SELECT race_date, place_code, CASE WHEN race_date <= (SELECT max(race_date) FROM races WHERE race_date <= DATE '2000-12-31') THEN 'stored' ELSE status END AS status
FROM quality""", dt="race_date", ctes=QUALITY)
def _(spark, sf):
    q = quality(spark, sf).select(*VENUE_DAY, "status")
    stored = q.where(F.col("race_date") <= F.lit("2000-12-31").cast("date")).withColumn("status", F.lit("stored"))
    return qa.quality_incremental(stored, q)


@query("filter_normal_days", f"""
SELECT e.race_date, e.place_code, e.race_no, car_no FROM runners e JOIN quality q ON e.race_date = q.race_date AND e.place_code = q.place_code
WHERE q.status = 'normal'""", dt="race_date", ctes=QUALITY)
def _(spark, sf):
    normal = quality(spark, sf).where(F.col("status") == "normal").select(*VENUE_DAY)
    return b.runners(spark, sf).select(*CAR).join(normal, VENUE_DAY, "left_semi")


@query("agg_nunique", "SELECT race_date, place_code, n_planned, n_results, n_payouts FROM venue_quality", dt="race_date", ctes=QUALITY)
def _(spark, sf):
    return quality(spark, sf).select(*VENUE_DAY, "n_planned", "n_results", "n_payouts")


@query("join_full_outer_counts", "SELECT * FROM counts", dt="race_date", ctes=COMPLETION)
def _(spark, sf):
    return jo.completion_counts(b.runners(spark, sf), b.results(spark, sf), b.payouts(spark, sf))


@query("join_two_level_default", f"SELECT {R}, reason FROM completion", dt="race_date", ctes=COMPLETION)
def _(spark, sf):
    counts = jo.completion_counts(b.runners(spark, sf), b.results(spark, sf), b.payouts(spark, sf))
    return jo.two_level_default(counts, b.voids(spark, sf)).select(*RACE, "reason")


@query("completion_race", f"SELECT {R}, n_entries, n_result_rows, n_tyaku, has_payout, canceled_day, status, void_reason FROM completion",
       dt="race_date", ctes=COMPLETION)
def _(spark, sf):
    return completion(spark, sf)


@query("completion_missing", f"""
SELECT {R}, status FROM completion WHERE race_date BETWEEN DATE '{FROM}' AND DATE '{TO}' AND race_date < DATE '{TODAY}' AND status LIKE 'missing%'""",
       dt="race_date", ctes=COMPLETION)
def _(spark, sf):
    return qa.completion_missing(completion(spark, sf), FROM, TO, TODAY).select(*RACE, "status")


@query("completion_counts", """
SELECT count(*) AS n_races, count(*) FILTER (status LIKE 'missing%') AS n_missing, count(*) FILTER (void_reason <> '') AS n_void FROM completion""",
       ctes=COMPLETION)
def _(spark, sf):
    return qa.completion_totals(completion(spark, sf))


@query("agg_stratified", "SELECT status, CAST(year(race_date) AS INT) AS year, count(*) AS n FROM completion GROUP BY 1, 2", ctes=COMPLETION)
def _(spark, sf):
    return ag.stratified(completion(spark, sf))


@query("refresh_window", f"""
SELECT {R}, CASE WHEN race_date < DATE '{TODAY}' - 30 THEN 'kept' ELSE status END AS status FROM completion""", dt="race_date", ctes=COMPLETION)
def _(spark, sf):
    from paceline.sources.tables import refresh_window
    fresh = completion(spark, sf).select(*RACE, "status")
    return refresh_window(fresh.withColumn("status", F.lit("kept")), fresh, TODAY, 30)


@query("lines_gap_summary", "SELECT * FROM gap_bands", dbl="rate", ctes=LINES)
def _(spark, sf):
    return qa.lines_gap_by_band(b.runners(spark, sf), known_lines(spark, sf), "1995-01-01", TO)


@query("lineup_gap_flag", """
SELECT races, missing_races, missing_races / races AS rate, CASE WHEN missing_races / races > 0.05 THEN 'warn' ELSE 'ok' END AS flag
FROM (SELECT CAST(sum(races) AS BIGINT) AS races, CAST(sum(missing_races) AS BIGINT) AS missing_races FROM gap_bands)""", dbl="rate", ctes=LINES)
def _(spark, sf):
    return qa.lineup_gap_flag(qa.lines_gap_by_band(b.runners(spark, sf), known_lines(spark, sf), "1995-01-01", TO))


@query("result_gaps", f"""
SELECT * FROM (SELECT {R}, CASE WHEN n_result_rows = 0 THEN 'results_gap' WHEN n_tyaku > 0 AND has_payout = 0 THEN 'payout_gap' END AS gap FROM counts)
WHERE gap IS NOT NULL""", dt="race_date", ctes=COMPLETION)
def _(spark, sf):
    return qa.result_gaps(b.runners(spark, sf), b.results(spark, sf), b.payouts(spark, sf))


@query("recovery_classify", f"""
SELECT race_date, place_code, race_no, prev_status, CASE WHEN err THEN 'parse_error'
  WHEN prev_status = 'missing_results' AND n_tyaku > 0 THEN 'recovered' WHEN prev_status = 'missing_results' AND n_result_rows > 0 THEN 'canceled_confirmed'
  WHEN prev_status <> 'missing_results' AND has_payout = 1 THEN 'recovered' ELSE 'still_missing' END AS outcome,
  CASE WHEN priority = '1-URGENT' THEN 0 ELSE 1 END AS is_side_effect FROM (
  SELECT r.race_date, r.place_code, r.race_no, priority, CASE WHEN status = 'F' THEN 'missing_results' ELSE 'missing_payout' END AS prev_status,
    coalesce(n_tyaku, 0) AS n_tyaku, coalesce(n_result_rows, 0) AS n_result_rows, coalesce(has_payout, 0) AS has_payout,
    EXISTS (SELECT 1 FROM races x WHERE x.race_date = r.race_date AND x.place_code = r.place_code AND x.segment = 'FURNITURE' AND x.status = 'P') AS err
  FROM races r LEFT JOIN counts c ON r.race_no = c.race_no WHERE status IN ('F', 'O'))""", dt="race_date", ctes=COMPLETION)
def _(spark, sf):
    r = b.races(spark, sf)
    missing = r.where(F.col("status").isin("F", "O")).select(
        *RACE, F.when(F.col("status") == "F", "missing_results").otherwise("missing_payout").alias("prev_status"))
    errors = r.where((F.col("segment") == "FURNITURE") & (F.col("status") == "P"))
    return qa.recovery_classify(missing, b.results(spark, sf), b.payouts(spark, sf), r.where(F.col("priority") == "1-URGENT"), errors)


@query("daily_health", "SELECT * FROM daily", dbl="lines_ratio snapshots_ratio", dt="race_date", ctes=HEALTH)
def _(spark, sf):
    return health(spark, sf)


@query("agg_daily_counts", "SELECT race_date, venues, entries, lines, results, payouts, snapshots_ok FROM health", dt="race_date", ctes=HEALTH)
def _(spark, sf):
    return health(spark, sf).select("race_date", "venues", "entries", "lines", "results", "payouts", "snapshots_ok")


@query("overall_status", f"""
SELECT *, CASE WHEN n_nodata > 0 THEN 'NG' WHEN n_warn > 0 OR n_missing > 0 THEN 'WARN' ELSE 'OK' END AS level FROM (
  SELECT count(*) AS n_total_days, count(*) FILTER (status IN ('ok', 'ok_with_note')) AS n_ok_days, count(*) FILTER (status = 'no_data') AS n_nodata,
    count(*) FILTER (status NOT IN ('ok', 'ok_with_note', 'no_data')) AS n_warn,
    (SELECT count(*) FROM completion WHERE race_date BETWEEN DATE '{FROM}' AND DATE '{TO}' AND race_date < DATE '{TODAY}' AND status LIKE 'missing%') AS n_missing
  FROM daily WHERE status <> 'in_progress')""", ctes={**HEALTH, **COMPLETION})
def _(spark, sf):
    return qa.overall_status(health(spark, sf), qa.completion_missing(completion(spark, sf), FROM, TO, TODAY))


def timing(spark, sf):
    return b.capture_log(spark, sf).withColumns({
        "done_lag_sec": F.col("capture_lag_sec") + F.col("fetch_sec"),
        "seconds_before_done": F.col("seconds_before_start") - F.col("fetch_sec")})


@query("capture_timing", """
SELECT target_offset_min, count(lag) AS n, quantile_cont(abs(lag), 0.95) AS done_lag_p95, quantile_cont(fetch_sec, 0.95) AS fetch_p95,
  max(lag) AS done_lag_max, count(*) FILTER (seconds_before_start - fetch_sec < 0) AS after_start
FROM (SELECT *, capture_lag_sec + fetch_sec AS lag FROM capture_log) WHERE status = 'ok' GROUP BY 1""",
       dbl="target_offset_min done_lag_p95 fetch_p95 done_lag_max")
def _(spark, sf):
    return qa.capture_timing(timing(spark, sf))


@query("agg_p95_abs", """
SELECT target_offset_min, quantile_cont(abs(capture_lag_sec), 0.95) AS p95, count(capture_lag_sec) AS n, max(abs(capture_lag_sec)) AS max_abs
FROM capture_log GROUP BY 1""", dbl="target_offset_min p95 max_abs")
def _(spark, sf):
    return ag.p95_abs(b.capture_log(spark, sf), ["target_offset_min"], "capture_lag_sec")


STATUS_SQL = """SELECT target_offset_min, count(*) FILTER (status = 'ok') AS n_ok, count(*) FILTER (status = 'no_odds') AS n_no_odds,
  count(*) FILTER (status = 'fail') AS n_fail FROM capture_log GROUP BY 1"""


@query("agg_conditional_counts", STATUS_SQL, dbl="target_offset_min")
def _(spark, sf):
    return ag.status_pivot(b.capture_log(spark, sf))


@query("capture_coverage", f"""
SELECT s.*, n, mean_lead, std_lead FROM ({STATUS_SQL}) s JOIN (SELECT target_offset_min, count(seconds_before_start) AS n,
  avg(seconds_before_start / 60) AS mean_lead, coalesce(stddev_samp(seconds_before_start / 60), 0) AS std_lead FROM capture_log WHERE status = 'ok' GROUP BY 1) l
USING (target_offset_min)""", dbl="target_offset_min mean_lead std_lead")
def _(spark, sf):
    log = b.capture_log(spark, sf)
    return ag.status_counts(log).join(qa.lead_summary(log), "target_offset_min")


@query("agg_mean_std", """SELECT target_offset_min, status, count(capture_lag_sec) AS n, avg(capture_lag_sec) AS mean,
  coalesce(stddev_samp(capture_lag_sec), 0) AS std FROM capture_log GROUP BY 1, 2""", dbl="target_offset_min mean std")
def _(spark, sf):
    return ag.mean_std(b.capture_log(spark, sf), ["target_offset_min", "status"], F.col("capture_lag_sec"))


@query("agg_distinct_races", f"SELECT count(DISTINCT ({R})) AS n_races FROM capture_log WHERE status = 'ok'")
def _(spark, sf):
    return ag.ok_races(b.capture_log(spark, sf))


@query("observation_stage", f"""SELECT n_races, CASE WHEN n_races < 30 THEN 'accumulate' WHEN n_races < 50 THEN 'audit' ELSE 'enough' END AS stage
FROM (SELECT count(DISTINCT ({R})) AS n_races FROM capture_log WHERE status = 'ok')""")
def _(spark, sf):
    return qa.observation_stage(ag.ok_races(b.capture_log(spark, sf)))


@query("agg_value_counts", "SELECT coalesce(nullif(trim(void_reason), ''), '(blank)') AS reason, count(*) AS n FROM completion GROUP BY 1", ctes=COMPLETION)
def _(spark, sf):
    return ag.value_table(completion(spark, sf), F.col("void_reason"), "reason")


@query("agg_max_payout", "SELECT bet_type, kumi_ban, max(payout) AS payout FROM payouts GROUP BY 1, 2")
def _(spark, sf):
    return ag.max_payout(b.payouts(spark, sf), ["bet_type", "kumi_ban"])


@query("prediction_completeness", f"""
SELECT e.race_date, e.place_code, e.race_no, count(*) AS n_expected, count(o.car_no) AS n_official, count(*) = count(o.car_no) AS complete
FROM runners e LEFT JOIN official o ON e.race_no = o.race_no AND e.car_no = o.car_no GROUP BY 1, 2, 3""", dt="race_date")
def _(spark, sf):
    ties = ["l_partkey", "l_suppkey", "l_quantity", "p_win"]
    return qa.prediction_completeness(select_official(b.official_runs(spark, sf), ties), b.runners(spark, sf))


@query("run_type_classify", """
SELECT run_class, run_type, count(*) AS n FROM (SELECT run_type, CASE WHEN predicted_at < first_start THEN 'official' ELSE 'rerun' END AS run_class
  FROM official_runs LEFT JOIN (SELECT race_date, min(start_dt) + INTERVAL 60 DAY AS first_start FROM capture_log GROUP BY 1) USING (race_date)) GROUP BY 1, 2""")
def _(spark, sf):
    starts = b.capture_log(spark, sf).select("race_date", (F.col("start_dt") + F.expr("interval 60 days")).alias("start_dt"))
    return qa.run_type_classify(b.official_runs(spark, sf), starts).groupBy("run_class", "run_type").agg(F.count(F.lit(1)).alias("n"))


@query("log_rebuild", f"""
SELECT {R}, target_offset_min, n_rows, status, '' AS note FROM capture_log WHERE status = 'ok'
UNION ALL SELECT {R}, target_offset_min, n_rows, 'ok', 'rebuilt' FROM (SELECT {R}, target_offset_min, count(*) AS n_rows FROM snapshots GROUP BY ALL) s
WHERE NOT EXISTS (SELECT 1 FROM capture_log c WHERE c.status = 'ok' AND c.race_no = s.race_no AND c.target_offset_min = s.target_offset_min)""",
       dbl="target_offset_min", dt="race_date")
def _(spark, sf):
    log = b.capture_log(spark, sf).where(F.col("status") == "ok").withColumn("n_rows", F.col("n_rows").cast("long"))
    return qa.log_rebuild(log, b.snapshots(spark, sf)).drop("snapshot_dt")


@query("log_backfill_seconds", f"""
SELECT {R}, target_offset_min, start_dt - to_microseconds(CAST(target_offset_min * 60000000 AS BIGINT)) AS scheduled,
  (epoch_us(start_dt) - epoch_us(snapshot_dt)) / 1e6 AS before_start,
  (epoch_us(snapshot_dt) - epoch_us(start_dt)) / 1e6 + target_offset_min * 60 AS lag FROM capture_log""",
       dbl="target_offset_min before_start lag", dt="race_date", ts="scheduled")
def _(spark, sf):
    return qa.log_backfill_seconds(b.capture_log(spark, sf)).select(*RACE, "target_offset_min", "scheduled", "before_start", "lag")


@query("recent_gaps", f"SELECT race_date, place_code, reason FROM voids WHERE race_date >= DATE '{TODAY}' - 60", dt="race_date")
def _(spark, sf):
    return qa.recent_gaps(b.voids(spark, sf), TODAY).select("race_date", "place_code", "reason")


@query("backfill_todo", """
SELECT race_date, place_code FROM quality q WHERE status = 'normal' AND NOT EXISTS (SELECT 1 FROM snapshots s
  WHERE s.race_date = q.race_date AND s.place_code = q.place_code AND s.bet_type = 'W')""", dt="race_date", ctes=QUALITY)
def _(spark, sf):
    return qa.backfill_todo(quality(spark, sf), b.snapshots(spark, sf).where(F.col("bet_type") == "W"))
