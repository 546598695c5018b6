"""Joins and set operations (2.3, 2.7) over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.keys import CAR, RACE
from paceline.operators import features as fe, joins as jo
from paceline.plans import bindings as b
from paceline.plans.features import LINES
from paceline.plans.quality import COMPLETION, completion
from paceline.plans.registry import query

R = "race_date, place_code, race_no"


@query("join_semi_anti_keys", f"""
SELECT {R}, car_no, race_no IN (SELECT race_no FROM payouts) AS has_payout FROM runners""", dt="race_date")
def _(spark, sf):
    e, p = b.runners(spark, sf).select(*CAR), b.payouts(spark, sf)
    return jo.keep_races(e, p).withColumn("has_payout", F.lit(True)).unionByName(jo.drop_races(e, p).withColumn("has_payout", F.lit(False)))


@query("join_overlap_count", """
SELECT (SELECT count(DISTINCT race_no) FROM snapshots WHERE bet_type IN ('ST2', 'SH2')) AS n_left, (SELECT count(DISTINCT race_no) FROM payouts) AS n_right,
  (SELECT count(DISTINCT race_no) FROM snapshots WHERE bet_type IN ('ST2', 'SH2') AND race_no IN (SELECT race_no FROM payouts)) AS n_both""")
def _(spark, sf):
    quoted = b.snapshots(spark, sf).where(F.col("bet_type").isin("ST2", "SH2"))
    return jo.overlap_count(quoted, b.payouts(spark, sf))


@query("join_asof_offset", f"""
SELECT {R}, kumi_ban, odds FROM snapshots WHERE bet_type = 'ST2' AND target_offset_min = 1 AND odds > 0 QUALIFY row_number() OVER (
  PARTITION BY {R}, kumi_ban ORDER BY snapshot_dt DESC, l_partkey DESC, l_suppkey DESC, odds DESC) = 1""", dbl="odds", dt="race_date")
def _(spark, sf):
    return jo.at_offset(b.snapshots(spark, sf), "ST2", 1.0, ["l_partkey", "l_suppkey"])


@query("join_time_start", f"""
SELECT {R}, car_no, target_offset_min, CAST(floor((epoch_us(snapshot_dt) - epoch_us(start_dt)) / 60000000) AS BIGINT) AS delta_min FROM capture_log""",
       dbl="target_offset_min", dt="race_date")
def _(spark, sf):
    from paceline.functions.moments import start_ts
    starts = b.races(spark, sf).select(*RACE, start_ts(F.col("race_date"), F.col("st_time")).alias("start_dt"))
    quotes = b.capture_log(spark, sf).drop("start_dt")
    return jo.minutes_from_start(quotes, starts).select(*CAR, "target_offset_min", "delta_min")


@query("union_partitions", f"SELECT {R}, bet_type, count(*) AS n, count(max_odds) AS n_ranged FROM snapshots GROUP BY ALL", dt="race_date")
def _(spark, sf):
    s = b.snapshots(spark, sf)
    cut = F.lit("1998-07-01").cast("date")
    months, legacy = s.where(F.col("race_date") >= cut), s.where(F.col("race_date") < cut)
    # The legacy part is read without the column where it is empty, as an older file would be.
    old = legacy.where(F.col("max_odds").isNull()).drop("max_odds")
    both = months.unionByName(legacy.where(F.col("max_odds").isNotNull())).unionByName(old, allowMissingColumns=True)
    return both.groupBy(*RACE, "bet_type").agg(F.count(F.lit(1)).alias("n"), F.count("max_odds").alias("n_ranged"))


@query("expected_minus_actual", f"""SELECT {R}, car_no FROM runners EXCEPT SELECT {R}, car_no FROM official_runs WHERE run_type = 'official'""", dt="race_date")
def _(spark, sf):
    return jo.missing_keys(b.runners(spark, sf), b.official_runs(spark, sf).where(F.col("run_type") == "official"))


@query("intersect_races", f"SELECT {R} FROM snapshots WHERE bet_type = 'ST2' INTERSECT SELECT {R} FROM payouts", dt="race_date")
def _(spark, sf):
    return jo.common_races(b.snapshots(spark, sf).where(F.col("bet_type") == "ST2"), b.payouts(spark, sf))


OVERLAP = {
    **LINES,
    "guess": f"SELECT race_no, car_no, coalesce(region, '不明') AS g FROM runners LEFT JOIN regions USING (prefecture)",
    "guess_pairs": "SELECT a.race_no, a.car_no AS i, z.car_no AS j FROM guess a JOIN guess z ON a.race_no = z.race_no AND a.g = z.g AND a.car_no < z.car_no",
    "true_pairs": "SELECT a.race_no, a.car_no AS i, z.car_no AS j FROM line_rows a JOIN line_rows z ON a.race_no = z.race_no AND a.line_id = z.line_id AND a.car_no < z.car_no",
    "pair_marks": "SELECT race_no, p, t FROM (SELECT *, true AS p FROM guess_pairs) FULL JOIN (SELECT *, true AS t FROM true_pairs) USING (race_no, i, j)",
    "race_marks": "SELECT race_no, count(p) AS p, count(t) AS t, count(*) FILTER (p AND t) AS c FROM pair_marks GROUP BY 1",
}


@query("pair_set_overlap", """
SELECT n_races, n_pred, n_true, n_correct, races_with_hit, n_races - not_exact AS n_exact, n_correct / n_pred AS precision, n_correct / n_true AS recall FROM (
  SELECT (SELECT count(DISTINCT race_no) FROM line_rows) AS n_races, CAST(sum(p) AS BIGINT) AS n_pred, CAST(sum(t) AS BIGINT) AS n_true,
    CAST(sum(c) AS BIGINT) AS n_correct, count(*) FILTER (c > 0) AS races_with_hit, count(*) FILTER (p <> c OR t <> c) AS not_exact FROM race_marks)""",
       dbl="precision recall", ctes=OVERLAP)
def _(spark, sf):
    guess = fe.group_guess(b.runners(spark, sf)).withColumnRenamed("region", "group")
    truth = fe.reconstruct_lines(b.narabi(spark, sf)).withColumnRenamed("line_id", "group")
    return jo.pair_overlap(guess, truth)


@query("backfill_plan", """
WITH days AS (SELECT CAST(d AS DATE) AS race_date FROM (SELECT unnest(range(DATE '2001-08-20' - 60, DATE '2001-08-20' - 1, INTERVAL 1 DAY)) AS d) WHERE d <> DATE '2001-07-10')
SELECT race_date, CAST(NULL AS INT) AS place_code FROM days WHERE race_date NOT IN (SELECT race_date FROM meta)
UNION ALL SELECT DISTINCT race_date, place_code FROM completion WHERE status LIKE 'missing%' AND race_date IN (SELECT race_date FROM days)
  AND race_date IN (SELECT race_date FROM meta)""", dt="race_date", ctes=COMPLETION)
def _(spark, sf):
    return jo.backfill_plan(b.meta(spark, sf), completion(spark, sf), "2001-08-20", 60, "2001-07-10")
