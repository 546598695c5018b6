"""Feature frames (2.9) over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.keys import CAR
from paceline.operators import features as fe
from paceline.operators.dedup import dedup_latest
from paceline.plans import bindings as b
from paceline.plans.registry import query

R = "race_date, place_code, race_no"

MARGINALS = {
    "per_car": f"""SELECT {R}, bet_type, odds, max_odds, popularity, side, cars[side + 1] AS car_no FROM (
      SELECT *, [CAST(split_part(replace(kumi_ban, '=', '-'), '-', 1) AS INT), CAST(split_part(replace(kumi_ban, '=', '-'), '-', 2) AS INT)] AS cars
      FROM latest_odds WHERE bet_type IN ('ST2', 'SH2', 'W')), (VALUES (0), (1)) t(side)""",
    "car_agg": f"""SELECT {R}, car_no, sum(1 / odds) FILTER (bet_type = 'ST2' AND side = 0) AS s1,
      sum(1 / odds) FILTER (bet_type = 'SH2') AS s2, sum(1 / odds) FILTER (bet_type = 'W') AS s3,
      min(popularity) FILTER (bet_type = 'ST2' AND side = 0) AS pop_rank_st2_1st,
      min(popularity) FILTER (bet_type = 'SH2') AS pop_rank_sh2_min,
      min(odds) FILTER (bet_type = 'ST2' AND side = 0) AS odds_min_st2_1st,
      count(*) FILTER (bet_type = 'ST2' AND side = 0) AS n_st2_first,
      max(CASE WHEN bet_type = 'SH2' OR (bet_type = 'ST2' AND side = 0) THEN 1 ELSE 0 END) AS has_odds,
      min(popularity) FILTER (bet_type = 'W') AS pop_rank_w_min, avg(odds) FILTER (bet_type = 'W') AS w_odds_min_avg,
      avg(max_odds - odds) FILTER (bet_type = 'W' AND max_odds <> 0) AS w_odds_range_avg,
      max(CASE WHEN bet_type = 'W' THEN 1 ELSE 0 END) AS has_w_odds FROM per_car GROUP BY ALL""",
    "marginals": f"""SELECT {R}, car_no, s1 / sum(s1) OVER w AS imp_winprob_st2, s2 / sum(s2) OVER w AS imp_top2prob_sh2,
      pop_rank_st2_1st, pop_rank_sh2_min, odds_min_st2_1st, ln(odds_min_st2_1st) AS log_odds_min_st2_1st, n_st2_first,
      CASE WHEN n_st2_first < count(*) OVER w - 1 THEN 1 ELSE 0 END AS is_incomplete_st2, has_odds,
      s3 / sum(s3) OVER w AS imp_top3prob_w, pop_rank_w_min, w_odds_min_avg, w_odds_range_avg, has_w_odds
      FROM car_agg WINDOW w AS (PARTITION BY {R})""",
}
MARGINAL_DBL = "imp_winprob_st2 imp_top2prob_sh2 odds_min_st2_1st log_odds_min_st2_1st imp_top3prob_w w_odds_min_avg w_odds_range_avg"

WEAK = {
    "weak_base": f"""SELECT runners.*, coalesce(region, '不明') AS region, (kyaku IN ('追', '両'))::INT AS s,
      (kyaku = '逃' OR (kyaku = '両' AND nige_cnt >= makuri_cnt)) AS leader FROM runners LEFT JOIN regions USING (prefecture)""",
    "weak": f"""SELECT {R}, car_no, leader::INT AS is_probable_line_leader, sr AS same_region_support_count,
      (sr > 0)::INT AS has_clear_regional_partner, (leader AND sr = 0)::INT AS is_likely_tanki,
      sp AS same_pref_support_count, nige_cnt / (nige_cnt + makuri_cnt + sasi_cnt + 1) AS nige_propensity FROM (
      SELECT *, CAST(greatest(sum(s) OVER (PARTITION BY {R}, region) - s, 0) AS BIGINT) AS sr,
        CAST(greatest(sum(s) OVER (PARTITION BY {R}, prefecture) - s, 0) AS BIGINT) AS sp FROM weak_base)""",
}

LINES = {
    "line_marks": f"""SELECT *, CASE WHEN lag(narabi_x) OVER w IS NOT NULL AND (narabi_y <> lag(narabi_y) OVER w
      OR narabi_x - lag(narabi_x) OVER w >= 2) THEN 1 ELSE 0 END AS brk
      FROM narabi WINDOW w AS (PARTITION BY {R} ORDER BY narabi_y, narabi_x, car_no)""",
    "line_ids": f"""SELECT *, CAST(sum(brk) OVER (PARTITION BY {R} ORDER BY narabi_y, narabi_x, car_no
      ROWS UNBOUNDED PRECEDING) AS BIGINT) AS line_id FROM line_marks""",
    "line_rows": f"""SELECT {R}, car_no, line_id, count(*) OVER (PARTITION BY {R}, line_id) AS line_size,
      row_number() OVER (PARTITION BY {R}, line_id ORDER BY narabi_y, narabi_x, car_no) AS line_pos FROM line_ids""",
    "real_lines": f"""SELECT l.race_date, l.place_code, l.race_no, l.car_no, line_size, line_pos,
      (line_pos = 1 AND line_size >= 2)::INT AS is_line_head, (line_pos = 2)::INT AS is_line_second,
      (line_pos >= 3)::INT AS is_line_third_plus, (line_size = 1)::INT AS is_tanki,
      CASE WHEN line_size > 1 THEN (line_pos - 1) / (line_size - 1) ELSE 0 END AS pos_ratio,
      count(DISTINCT line_id) OVER v AS n_lines_in_race, max(line_size) OVER v AS max_line_size,
      (line_size = max(line_size) OVER v)::INT AS is_in_largest_line,
      dense_rank() OVER (PARTITION BY l.race_date, l.place_code, l.race_no ORDER BY line_size DESC) AS line_size_rank,
      CAST(sum((line_size = 1)::INT) OVER v AS BIGINT) AS n_tanki_in_race,
      CASE WHEN line_pos = 1 AND line_size >= 2 THEN coalesce(nige_cnt / (nige_cnt + makuri_cnt + sasi_cnt + 1), 0) ELSE 0 END AS head_nige_propensity
      FROM line_rows l LEFT JOIN runners r ON l.race_no = r.race_no AND l.car_no = r.car_no
      WINDOW v AS (PARTITION BY l.race_date, l.place_code, l.race_no)""",
}

RELATIVE = {
    "relative": f"""SELECT *, CASE WHEN syouritu IS NOT NULL THEN dense_rank() OVER (PARTITION BY {R} ORDER BY syouritu DESC NULLS LAST) END AS syouritu_rank,
      dense_rank() OVER (PARTITION BY {R} ORDER BY rentairitu2 DESC) AS rentairitu2_rank,
      dense_rank() OVER (PARTITION BY {R} ORDER BY rentairitu3 DESC) AS rentairitu3_rank,
      dense_rank() OVER (PARTITION BY {R} ORDER BY heikin_tokuten DESC) AS heikin_tokuten_rank,
      dense_rank() OVER (PARTITION BY {R} ORDER BY age) AS age_rank,
      max(syouritu) OVER w - syouritu AS syouritu_gap, max(rentairitu2) OVER w - rentairitu2 AS rentairitu2_gap,
      max(heikin_tokuten) OVER w - heikin_tokuten AS heikin_tokuten_gap, count(car_no) OVER w AS race_n_cars,
      avg(syouritu) OVER w AS race_mean_syouritu, coalesce(stddev_samp(syouritu) OVER w, 0) AS race_std_syouritu,
      CAST(sum((kyaku = '逃')::INT) OVER w AS BIGINT) AS n_nige_in_race,
      CAST(sum((kyuhan LIKE 'S%')::INT) OVER w AS BIGINT) AS "n_S_class_in_race"
      FROM runners WINDOW w AS (PARTITION BY {R})""",
}
MISPRICE = {
    **MARGINALS, **RELATIVE,
    "priced": f"""SELECT r.*, m.* EXCLUDE (race_date, place_code, race_no, car_no),
      CASE WHEN pop_rank_st2_1st IS NOT NULL THEN dense_rank() OVER (PARTITION BY r.race_date, r.place_code, r.race_no
        ORDER BY pop_rank_st2_1st NULLS LAST) END AS pop,
      syouritu / CASE WHEN sum(syouritu) OVER v = 0 THEN 1 ELSE sum(syouritu) OVER v END AS implied
      FROM relative r LEFT JOIN marginals m ON r.race_no = m.race_no AND r.car_no = m.car_no
      WINDOW v AS (PARTITION BY r.race_date, r.place_code, r.race_no)""",
}


def marginals(spark, sf):
    return fe.market_marginals(dedup_latest(b.snapshots(spark, sf), b.SNAP_TIES))


@query("feat_market_marginals", "SELECT * FROM marginals", dbl=MARGINAL_DBL, dt="race_date", ctes=MARGINALS)
def _(spark, sf):
    return marginals(spark, sf)


@query("feat_weak_lines", "SELECT * FROM weak", dbl="nige_propensity", dt="race_date", ctes=WEAK)
def _(spark, sf):
    return fe.weak_line_features(b.runners(spark, sf))


@query("feat_real_lines", "SELECT * FROM real_lines", dbl="pos_ratio head_nige_propensity", dt="race_date", ctes=LINES)
def _(spark, sf):
    r = b.runners(spark, sf)
    return fe.real_line_features(b.narabi(spark, sf), r)


@query("feat_group_guess", f"""
SELECT {R}, car_no, coalesce(region, '不明') AS region, CAST(row_number() OVER (PARTITION BY {R}, coalesce(region, '不明')
  ORDER BY CASE WHEN kyaku IN ('逃', '両') THEN 0 ELSE 1 END, car_no) AS INT) AS group_pos,
  count(*) OVER (PARTITION BY {R}, coalesce(region, '不明')) AS group_size FROM runners LEFT JOIN regions USING (prefecture)""",
       dt="race_date")
def _(spark, sf):
    return fe.group_guess(b.runners(spark, sf))


@query("feat_race_relative", f"""
SELECT {R}, car_no, syouritu_rank, rentairitu2_rank, rentairitu3_rank, heikin_tokuten_rank, age_rank, syouritu_gap,
  rentairitu2_gap, heikin_tokuten_gap, race_n_cars, race_mean_syouritu, race_std_syouritu, n_nige_in_race, "n_S_class_in_race"
FROM relative""", dbl="syouritu_gap rentairitu2_gap heikin_tokuten_gap race_mean_syouritu race_std_syouritu", dt="race_date",
       ctes=RELATIVE)
def _(spark, sf):
    ranks = [f"{c}_rank" for c in ["syouritu", "rentairitu2", "rentairitu3", "heikin_tokuten", "age"]]
    return fe.race_relative(b.runners(spark, sf)).select(
        *CAR, *[F.col(c).cast("long") for c in ranks], "syouritu_gap", "rentairitu2_gap", "heikin_tokuten_gap",
        "race_n_cars", "race_mean_syouritu", "race_std_syouritu", "n_nige_in_race", "n_S_class_in_race")


@query("feat_mispricing", f"""
SELECT {R}, car_no, pop - syouritu_rank AS pop_minus_syouritu_rank, pop - rentairitu2_rank AS pop_minus_rentairitu2_rank,
  pop - heikin_tokuten_rank AS pop_minus_heikin_tokuten_rank, imp_winprob_st2 - implied AS imp_winprob_residual,
  coalesce(pop >= 3 AND syouritu_rank <= 2, false)::INT AS is_underpriced_stats_top,
  coalesce(pop <= 2 AND syouritu_rank >= 5, false)::INT AS is_overpriced_market_top FROM priced""",
       dbl="imp_winprob_residual", dt="race_date", ctes=MISPRICE)
def _(spark, sf):
    df = fe.race_relative(b.runners(spark, sf)).join(marginals(spark, sf), CAR, "left")
    diffs = ["pop_minus_syouritu_rank", "pop_minus_rentairitu2_rank", "pop_minus_heikin_tokuten_rank"]
    return fe.mispricing(df).select(
        *CAR, *[F.col(c).cast("long") for c in diffs], "imp_winprob_residual", "is_underpriced_stats_top",
        "is_overpriced_market_top")


@query("feat_targets", f"""
SELECT {R}, car_no, coalesce(tyaku = 1, false)::INT AS y_win, coalesce(tyaku BETWEEN 1 AND 2, false)::INT AS y_top2,
  coalesce(tyaku BETWEEN 1 AND 3, false)::INT AS y_top3, coalesce(tyaku, 8) AS y_rank FROM results""", dt="race_date")
def _(spark, sf):
    return fe.targets(b.results(spark, sf)).drop("tyaku")


ASSEMBLE = {**MISPRICE, **WEAK, **LINES}
ASSEMBLE_COLS = ["grade", "kyaku", "kyuhan", "syouritu", "race_mean_syouritu", "imp_winprob_st2", "has_odds", "is_incomplete_st2",
                 "nige_propensity", "line_size", "pos_ratio", "imp_winprob_residual", "y_win", "y_top2", "y_top3", "y_rank"]


def dataset(spark, sf):
    r = b.runners(spark, sf)
    return fe.assemble(r, b.meta(spark, sf), marginals(spark, sf), fe.weak_line_features(r),
                       fe.real_line_features(b.narabi(spark, sf), r), b.results(spark, sf))


@query("dataset_assemble", f"""
SELECT p.race_date, p.place_code, p.race_no, p.car_no, grade, kyaku, kyuhan, syouritu, race_mean_syouritu, imp_winprob_st2,
  coalesce(has_odds, 0) AS has_odds, coalesce(is_incomplete_st2, 1) AS is_incomplete_st2, nige_propensity, line_size, pos_ratio,
  imp_winprob_st2 - implied AS imp_winprob_residual, coalesce(tyaku = 1, false)::INT AS y_win,
  coalesce(tyaku BETWEEN 1 AND 2, false)::INT AS y_top2, coalesce(tyaku BETWEEN 1 AND 3, false)::INT AS y_top3,
  coalesce(tyaku, 8) AS y_rank
FROM priced p LEFT JOIN meta ON p.race_date = meta.race_date AND p.place_code = meta.place_code
LEFT JOIN weak k ON p.race_no = k.race_no AND p.car_no = k.car_no
LEFT JOIN real_lines x ON p.race_no = x.race_no AND p.car_no = x.car_no
LEFT JOIN results s ON p.race_no = s.race_no AND p.car_no = s.car_no""",
       dbl="syouritu race_mean_syouritu imp_winprob_st2 nige_propensity pos_ratio imp_winprob_residual", dt="race_date",
       ctes=ASSEMBLE)
def _(spark, sf):
    return dataset(spark, sf).select(*CAR, *ASSEMBLE_COLS)


@query("join_feature_assembly", f"""
SELECT r.race_date, r.place_code, r.race_no, r.car_no, grade, imp_winprob_st2, is_likely_tanki, line_size, tyaku
FROM runners r LEFT JOIN meta ON r.race_date = meta.race_date AND r.place_code = meta.place_code
LEFT JOIN marginals m ON r.race_no = m.race_no AND r.car_no = m.car_no
LEFT JOIN weak k ON r.race_no = k.race_no AND r.car_no = k.car_no
LEFT JOIN real_lines x ON r.race_no = x.race_no AND r.car_no = x.car_no
LEFT JOIN results s ON r.race_no = s.race_no AND r.car_no = s.car_no""", dbl="imp_winprob_st2", dt="race_date", ctes=ASSEMBLE)
def _(spark, sf):
    r = b.runners(spark, sf)
    return (
        r.select(*CAR).join(b.meta(spark, sf), ["race_date", "place_code"], "left")
        .join(marginals(spark, sf), CAR, "left").join(fe.weak_line_features(r), CAR, "left")
        .join(fe.real_line_features(b.narabi(spark, sf), r), CAR, "left").join(b.results(spark, sf), CAR, "left")
        .select(*CAR, "grade", "imp_winprob_st2", "is_likely_tanki", "line_size", "tyaku"))


@query("split_by_date", """
SELECT split, count(*) AS n, CAST(sum(y) AS BIGINT) AS wins FROM (SELECT CASE WHEN race_date <= DATE '1999-12-31' THEN 'train'
  WHEN race_date >= DATE '2000-01-01' THEN 'test' END AS split, coalesce(tyaku = 1, false)::INT AS y FROM results) GROUP BY 1""")
def _(spark, sf):
    df = fe.split_by_date(fe.targets(b.results(spark, sf)), "1999-12-31", "2000-01-01")
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("y_win").alias("wins"))
