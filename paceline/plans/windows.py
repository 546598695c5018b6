"""Deduplication, ranks and shares within races, ordered splits (2.5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.keys import CAR, COMBO, RACE
from paceline.operators import dedup, ranks
from paceline.operators.combos import combo_mass_check
from paceline.plans import bindings as b
from paceline.plans.registry import query

R = "race_date, place_code, race_no"
LOG_KEY = [*RACE, "target_offset_min"]


@query("dedup_latest", f"""
SELECT {R}, bet_type, kumi_ban, odds, popularity, snapshot_dt, target_offset_min FROM latest_odds""",
       dbl="odds target_offset_min", dt="race_date", ts="snapshot_dt")
def _(spark, sf):
    return dedup.dedup_latest(b.snapshots(spark, sf), b.SNAP_TIES).select(
        *COMBO, "odds", "popularity", "snapshot_dt", "target_offset_min")


@query("dedup_latest_by_offset", f"""
SELECT {R}, bet_type, kumi_ban, target_offset_min, odds, snapshot_dt FROM snapshots WHERE odds > 0
QUALIFY row_number() OVER (PARTITION BY {R}, bet_type, kumi_ban, target_offset_min ORDER BY snapshot_dt DESC,
  l_partkey DESC, l_suppkey DESC, odds DESC, popularity DESC) = 1""",
       dbl="odds target_offset_min", dt="race_date", ts="snapshot_dt")
def _(spark, sf):
    return dedup.dedup_latest_by_offset(b.snapshots(spark, sf), b.SNAP_TIES[:-1]).select(
        *COMBO, "target_offset_min", "odds", "snapshot_dt")


@query("dedup_first", f"""
SELECT {R}, target_offset_min, status, n_rows FROM capture_log
QUALIFY row_number() OVER (PARTITION BY {R}, target_offset_min ORDER BY snapshot_dt, l_partkey, l_suppkey, car_no,
  status, n_rows) = 1""", dbl="target_offset_min", dt="race_date")
def _(spark, sf):
    order = [F.col(c) for c in ["snapshot_dt", "l_partkey", "l_suppkey", "car_no", "status", "n_rows"]]
    return dedup.first_per_key(b.capture_log(spark, sf), LOG_KEY, order, ["status", "n_rows"])


@query("dedup_exact", f"""
SELECT CAST(count(*) AS BIGINT) AS n_before, (SELECT count(*) FROM (SELECT DISTINCT {R}, bet_type, odds FROM snapshots)) AS n_after,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT {R}, bet_type, odds FROM snapshots)) AS n_removed FROM snapshots""")
def _(spark, sf):
    return dedup.exact_duplicates(b.snapshots(spark, sf).select(*RACE, "bet_type", "odds"))


@query("dup_key_count", f"""
SELECT count(*) AS n_rows, count(DISTINCT ({R}, bet_type, kumi_ban)) AS n_keys,
  count(*) - count(DISTINCT ({R}, bet_type, kumi_ban)) AS n_surplus FROM snapshots""")
def _(spark, sf):
    return dedup.dup_key_count(b.snapshots(spark, sf), COMBO)


@query("select_official", f"SELECT {R}, car_no, p_win, predicted_at FROM official",
       dbl="p_win", dt="race_date", ts="predicted_at")
def _(spark, sf):
    ties = ["l_partkey", "l_suppkey", "l_quantity", "p_win"]
    return dedup.select_official(b.official_runs(spark, sf), ties).select(*CAR, "p_win", "predicted_at")


@query("rank_in_race", f"""
SELECT {R}, car_no,
  CASE WHEN syouritu IS NOT NULL THEN dense_rank() OVER (PARTITION BY {R} ORDER BY syouritu DESC NULLS LAST) END AS syouritu_rank,
  dense_rank() OVER (PARTITION BY {R} ORDER BY rentairitu2 DESC NULLS LAST) AS rentairitu2_rank,
  dense_rank() OVER (PARTITION BY {R} ORDER BY rentairitu3 DESC NULLS LAST) AS rentairitu3_rank,
  dense_rank() OVER (PARTITION BY {R} ORDER BY heikin_tokuten DESC NULLS LAST) AS heikin_tokuten_rank,
  dense_rank() OVER (PARTITION BY {R} ORDER BY age NULLS LAST) AS age_rank FROM runners""", dt="race_date")
def _(spark, sf):
    df = ranks.rank_in_race(b.runners(spark, sf))
    names = ["syouritu_rank", "rentairitu2_rank", "rentairitu3_rank", "heikin_tokuten_rank", "age_rank"]
    return df.select(*CAR, *[F.col(c).cast("long") for c in names])


@query("gap_to_leader", f"""
SELECT {R}, car_no, max(syouritu) OVER w - syouritu AS syouritu_gap, max(rentairitu2) OVER w - rentairitu2 AS rentairitu2_gap,
  max(heikin_tokuten) OVER w - heikin_tokuten AS heikin_tokuten_gap FROM runners WINDOW w AS (PARTITION BY {R})""",
       dbl="syouritu_gap rentairitu2_gap heikin_tokuten_gap", dt="race_date")
def _(spark, sf):
    return ranks.gap_to_leader(b.runners(spark, sf)).select(*CAR, "syouritu_gap", "rentairitu2_gap", "heikin_tokuten_gap")


@query("race_moments", f"""
SELECT {R}, car_no, count(car_no) OVER w AS race_n_cars, avg(syouritu) OVER w AS race_mean_syouritu,
  coalesce(stddev_samp(syouritu) OVER w, 0) AS race_std_syouritu FROM runners WINDOW w AS (PARTITION BY {R})""",
       dbl="race_mean_syouritu race_std_syouritu", dt="race_date")
def _(spark, sf):
    return ranks.race_moments(b.runners(spark, sf)).select(*CAR, "race_n_cars", "race_mean_syouritu", "race_std_syouritu")


@query("race_style_counts", f"""
SELECT {R}, car_no, CAST(sum((kyaku = '逃')::INT) OVER w AS BIGINT) AS n_nige_in_race,
  CAST(sum((kyaku = '追')::INT) OVER w AS BIGINT) AS n_oikomi_in_race,
  CAST(sum((kyaku = '両')::INT) OVER w AS BIGINT) AS n_ryouten_in_race,
  CAST(sum((kyuhan LIKE 'S%')::INT) OVER w AS BIGINT) AS n_S_class_in_race
FROM runners WINDOW w AS (PARTITION BY {R})""", dt="race_date")
def _(spark, sf):
    return ranks.race_style_counts(b.runners(spark, sf)).select(
        *CAR, "n_nige_in_race", "n_oikomi_in_race", "n_ryouten_in_race", "n_S_class_in_race")


@query("normalise_in_race", f"""
SELECT {R}, car_no, price / CASE WHEN sum(price) OVER w = 0 THEN 1 ELSE sum(price) OVER w END AS q
FROM runners WINDOW w AS (PARTITION BY {R})""", dbl="q", dt="race_date")
def _(spark, sf):
    return ranks.normalise_in_race(b.runners(spark, sf), "price", "q").select(*CAR, "q")


@query("group_support_excl_self", f"""
SELECT {R}, car_no, CAST(greatest(sum(s) OVER (PARTITION BY {R}, region) - s, 0) AS BIGINT) AS same_region_support_count
FROM (SELECT runners.*, coalesce(region, '不明') AS region, (kyaku IN ('追', '両'))::INT AS s FROM runners
  LEFT JOIN regions USING (prefecture))""", dt="race_date")
def _(spark, sf):
    from paceline.functions.regions import add_region
    df = add_region(b.runners(spark, sf))
    return ranks.support_excl_self(df, "region", "same_region_support_count").select(*CAR, "same_region_support_count")


SESSION_SQL = f"""SELECT {R}, car_no, CAST(line_id AS BIGINT) AS line_id,
  CAST(row_number() OVER (PARTITION BY {R}, line_id ORDER BY narabi_y, narabi_x, car_no) AS BIGINT) AS line_pos,
  count(*) OVER (PARTITION BY {R}, line_id) AS line_size FROM (
  SELECT *, sum(brk) OVER (PARTITION BY {R} ORDER BY narabi_y, narabi_x, car_no ROWS UNBOUNDED PRECEDING) AS line_id FROM (
    SELECT *, CASE WHEN lag(narabi_x) OVER w IS NOT NULL AND (narabi_y <> lag(narabi_y) OVER w
      OR narabi_x - lag(narabi_x) OVER w >= 2) THEN 1 ELSE 0 END AS brk
    FROM narabi WINDOW w AS (PARTITION BY {R} ORDER BY narabi_y, narabi_x, car_no)))"""


@query("gap_sessionise", SESSION_SQL, dt="race_date")
def _(spark, sf):
    from paceline.operators.features import reconstruct_lines
    return reconstruct_lines(b.narabi(spark, sf)).select(*CAR, "line_id", "line_pos", "line_size")


@query("top_k_in_group", f"""
SELECT {R}, car_no, p_top2, CAST(rk AS INT) AS rk FROM (SELECT *, row_number() OVER (
  PARTITION BY {R} ORDER BY p_top2 DESC, car_no) AS rk FROM predictions) WHERE rk <= 2""", dbl="p_top2", dt="race_date")
def _(spark, sf):
    return ranks.top_k(b.predictions(spark, sf), RACE, [F.desc("p_top2"), F.col("car_no")], 2).select(*CAR, "p_top2", "rk")


@query("argmax_in_group", f"""
SELECT {R}, car_no, p_win FROM predictions QUALIFY row_number() OVER (PARTITION BY {R} ORDER BY p_win DESC, car_no) = 1""",
       dbl="p_win", dt="race_date")
def _(spark, sf):
    return ranks.argmax(b.predictions(spark, sf).select(*CAR, "p_win"), RACE, "p_win", "car_no")


@query("block_split", f"""
SELECT {R}, CAST(floor((row_number() OVER (ORDER BY {R}) - 1) * 5 / (SELECT count(*) FROM races)) AS BIGINT) AS blk FROM races""",
       dt="race_date")
def _(spark, sf):
    return ranks.block_split(b.race_keys(spark, sf), 5).select(*RACE, "blk")


@query("cum_tail_split", f"""
SELECT part, count(*) AS n, min(race_date) AS first_date, max(race_date) AS last_date FROM (
  SELECT race_date, CASE WHEN datediff('day', DATE '1970-01-01', race_date) > (SELECT quantile_cont(d, 0.9) FROM (
    SELECT datediff('day', DATE '1970-01-01', race_date) AS d FROM runners)) THEN 'valid' ELSE 'train' END AS part FROM runners)
GROUP BY part""", dt="first_date last_date")
def _(spark, sf):
    return ranks.cum_tail_split(b.runners(spark, sf).select(*CAR), 0.9).groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.min("race_date").alias("first_date"), F.max("race_date").alias("last_date"))
