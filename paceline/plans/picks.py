"""Picks, settlement and back-tests (2.11, 2.6) over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.keys import CAPTURE_OFFSETS, CAR, COMBO, RACE
from paceline.operators import joins as jo, picks as pk, quality as qa
from paceline.plans import bindings as b
from paceline.plans.market import EV, alt_combos
from paceline.plans.quality import COMPLETION, completion
from paceline.plans.registry import query

R = "race_date, place_code, race_no"
LOCK_DATE = "1999-01-01"
COMPLETE = "race_no IN (SELECT race_no FROM completion WHERE status = 'complete')"
CALIBRATION_END = "1999-12-31"

PICKS = {
    "ranked": f"""SELECT {R}, list(car_no ORDER BY p_win DESC, car_no) AS w, list(car_no ORDER BY p_top2 DESC, car_no) AS t2,
      list(car_no ORDER BY p_top3 DESC, car_no) AS t3, list(p_win ORDER BY p_win DESC, car_no) AS pw,
      list(p_top2 ORDER BY p_top2 DESC, car_no) AS p2, list(p_top3 ORDER BY p_top3 DESC, car_no) AS p3
      FROM predictions GROUP BY ALL HAVING count(*) >= 3""",
    "picks": f"""SELECT {R}, array_to_string(list_sort(t2[1:2]), '=') AS "SH2",
      concat(w[1], '-', CASE WHEN t2[1] <> w[1] THEN t2[1] ELSE t2[2] END) AS "ST2",
      array_to_string(list_sort(t3[1:3]), '=') AS "RH3", array_to_string(w[1:3], '-') AS "RT3",
      array_to_string(list_sort([t3[1], t3[2]]), '=') AS "W1", array_to_string(list_sort([t3[1], t3[3]]), '=') AS "W2",
      array_to_string(list_sort([t3[2], t3[3]]), '=') AS "W3",
      round((p2[1] + p2[2]) * 1e9) / 1e9 AS "conf_SH2", round((pw[1] + pw[2] + pw[3]) * 1e9) / 1e9 AS "conf_ST2",
      round((p3[1] + p3[2] + p3[3]) * 1e9) / 1e9 AS "conf_RH3", round((pw[1] + pw[2] + pw[3]) * 1e9) / 1e9 AS "conf_RT3",
      round((p3[1] + p3[2] + p3[3]) * 1e9) / 1e9 AS "conf_W" FROM ranked""",
    "tickets": f"""SELECT {R}, bet_type, kumi_ban, conf FROM picks, LATERAL (VALUES ('SH2', "SH2", "conf_SH2"), ('ST2', "ST2", "conf_ST2"),
      ('RH3', "RH3", "conf_RH3"), ('RT3', "RT3", "conf_RT3"), ('W', "W1", "conf_W"), ('W', "W2", "conf_W"), ('W', "W3", "conf_W")) t(bet_type, kumi_ban, conf)""",
    "best_pay": "SELECT race_no, bet_type, kumi_ban, max(payout) AS payout FROM payouts GROUP BY ALL",
    "settled": """SELECT t.* , coalesce(payout, 0) AS payout FROM tickets t LEFT JOIN best_pay p
      ON t.race_no = p.race_no AND t.bet_type = p.bet_type AND t.kumi_ban = p.kumi_ban""",
    "per_race": f"""SELECT {R}, bet_type, max(conf) AS conf, count(*) AS n_tickets, count(*) FILTER (payout > 0) AS hits,
      CAST(sum(payout) AS BIGINT) AS paid FROM settled GROUP BY ALL""",
}
SHARES = "(VALUES (1.0::DOUBLE, 100), (0.5, 50), (0.25, 25), (0.1, 10), (0.05, 5)) s(share, pct)"
TOPFRAC = {
    **PICKS,
    "topfrac": f"""SELECT bet_type, pct AS threshold_pct, count(*) AS n_races, CAST(sum(hits) AS BIGINT) AS n_hits,
      CAST(sum(paid) AS BIGINT) AS total_payout, CAST(sum(n_tickets) * 100 AS BIGINT) AS total_cost,
      sum(paid) / (sum(n_tickets) * 100) - 1 AS roi FROM (
      SELECT *, row_number() OVER (PARTITION BY bet_type ORDER BY conf DESC, {R}) AS pos, count(*) OVER (PARTITION BY bet_type) AS n
      FROM per_race), {SHARES} WHERE pos <= greatest(1, floor(n * share)) GROUP BY 1, 2""",
}
CAL = {
    **PICKS,
    "edges": f"""SELECT bet_type, list_sort(list_distinct(list_transform(quantile_cont(conf, [{', '.join(f'{i}/20' for i in range(21))}]),
      lambda e: round(e * 1e9) / 1e9))) AS edges FROM per_race WHERE race_date <= DATE '{CALIBRATION_END}' GROUP BY 1""",
    "all_edges": f"""SELECT bet_type, list_sort(list_distinct(list_transform(quantile_cont(conf, [{', '.join(f'{i}/20' for i in range(21))}]),
      lambda e: round(e * 1e9) / 1e9))) AS edges FROM per_race GROUP BY 1""",
    "binned": f"""SELECT p.*, race_date <= DATE '{CALIBRATION_END}' AS cal, CASE WHEN p.bet_type = 'W' THEN 300 ELSE 100 END AS cost,
      CASE WHEN conf >= edges[1] AND conf <= edges[-1] THEN greatest(len(list_filter(edges, lambda e: e < conf)), 1) END AS bin
      FROM per_race p JOIN edges e ON p.bet_type = e.bet_type""",
    "good": "SELECT bet_type, bin FROM binned WHERE cal AND bin IS NOT NULL GROUP BY 1, 2 HAVING avg(paid) > max(cost)",
}
GRID = {
    **EV,
    "priced": """SELECT m.race_date, m.place_code, m.race_no, m.bet_type, m.kumi_ban, m.target_offset_min, round(p_combo * odds * 1e9) / 1e9 AS ev,
      coalesce(payout, 0) AS payout FROM alt_combos c JOIN market_by_offset m ON c.race_no = m.race_no AND c.bet_type = m.bet_type
        AND c.kumi_ban = m.kumi_ban LEFT JOIN (SELECT race_no, bet_type, kumi_ban, max(payout) AS payout FROM payouts GROUP BY ALL) p
      ON m.race_no = p.race_no AND m.bet_type = p.bet_type AND m.kumi_ban = p.kumi_ban""",
}
PAIRS = {
    "pairs2": f"""SELECT {R}, array_to_string(list_sort(list(car_no ORDER BY p_win DESC, car_no)[1:2]), '=') AS champ_pair,
      array_to_string(list_sort(list(car_no ORDER BY p_top2 DESC, car_no)[1:2]), '=') AS cand_pair
      FROM predictions GROUP BY ALL HAVING count(*) >= 2""",
    "sh2": "SELECT race_no, kumi_ban, max(payout) / 100 AS odds FROM payouts WHERE bet_type = 'SH2' GROUP BY 1, 2",
    "pair_frame": f"""SELECT p.race_date, p.place_code, p.race_no, champ_pair, cand_pair, CASE WHEN settled THEN coalesce(a.odds, 0) END AS champ_ret,
      CASE WHEN settled THEN coalesce(z.odds, 0) END AS cand_ret FROM pairs2 p
      LEFT JOIN sh2 a ON p.race_no = a.race_no AND champ_pair = a.kumi_ban LEFT JOIN sh2 z ON p.race_no = z.race_no AND cand_pair = z.kumi_ban
      LEFT JOIN (SELECT DISTINCT race_no, true AS settled FROM sh2) s ON p.race_no = s.race_no""",
}


def picks(spark, sf):
    return pk.make_picks(b.predictions(spark, sf))


def duel(spark, sf):
    """Champion and candidate scores per car."""
    return b.predictions(spark, sf).select(*CAR, F.col("p_win").alias("p_champion"), F.col("p_top2").alias("p_candidate"))


def bets(spark, sf, thresholds):
    return pk.grid_bets(alt_combos(spark, sf), b.market_by_offset(spark, sf).where(F.col("bet_type") != "W"), b.payouts(spark, sf), thresholds)


@query("make_picks", "SELECT * FROM picks", dbl='"conf_SH2" "conf_ST2" "conf_RH3" "conf_RT3" "conf_W"', dt="race_date", ctes=PICKS)
def _(spark, sf):
    return picks(spark, sf)


ROI_SQL = """bet_type, count(*) AS n_bets, count(*) FILTER (payout > 0) AS n_hits, count(*) FILTER (payout > 0) / count(*) AS hit_rate,
  CAST(sum(payout) AS BIGINT) AS total_payout, count(*) * 100 AS total_cost, sum(payout) / (count(*) * 100) - 1 AS roi"""


@query("backtest_all", f"SELECT {ROI_SQL} FROM settled GROUP BY 1", dbl="hit_rate roi", ctes=PICKS)
def _(spark, sf):
    return pk.backtest(picks(spark, sf), b.payouts(spark, sf))


@query("join_lookup_default", f"SELECT {R}, bet_type, kumi_ban, payout FROM settled", dt="race_date", ctes=PICKS)
def _(spark, sf):
    return pk.settle_tickets(pk.tickets_of(picks(spark, sf)), b.payouts(spark, sf)).select(*COMBO, "payout")


@query("backtest_topfrac", "SELECT * FROM topfrac", dbl="roi", ctes=TOPFRAC)
def _(spark, sf):
    return pk.backtest_topfrac(picks(spark, sf), b.payouts(spark, sf))


@query("agg_pivot_threshold", """
SELECT bet_type, max(roi) FILTER (threshold_pct = 100) AS roi_100, max(roi) FILTER (threshold_pct = 50) AS roi_50,
  max(roi) FILTER (threshold_pct = 25) AS roi_25, max(roi) FILTER (threshold_pct = 10) AS roi_10,
  max(roi) FILTER (threshold_pct = 5) AS roi_5 FROM topfrac GROUP BY 1""", dbl="roi_100 roi_50 roi_25 roi_10 roi_5", ctes=TOPFRAC)
def _(spark, sf):
    return pk.pivot_threshold(pk.backtest_topfrac(picks(spark, sf), b.payouts(spark, sf)))


@query("sort_by_confidence_topfrac", f"""
SELECT {R}, "conf_ST2" AS conf FROM (SELECT *, row_number() OVER (ORDER BY "conf_ST2" DESC, {R}) AS pos, count(*) OVER () AS n FROM picks)
WHERE pos <= greatest(1, floor(n * 0.1))""", dbl="conf", dt="race_date", ctes=PICKS)
def _(spark, sf):
    return pk.top_share_races(picks(spark, sf), "conf_ST2", 0.1).select(*RACE, F.col("conf_ST2").alias("conf"))


@query("annotate_payouts", f"""
SELECT {R}, CAST(sum(payout) FILTER (bet_type = 'SH2') AS BIGINT) AS "pay_SH2", CAST(sum(payout) FILTER (bet_type = 'ST2') AS BIGINT) AS "pay_ST2",
  CAST(sum(payout) FILTER (bet_type = 'RH3') AS BIGINT) AS "pay_RH3", CAST(sum(payout) FILTER (bet_type = 'RT3') AS BIGINT) AS "pay_RT3",
  CAST(sum(payout) FILTER (bet_type = 'W') AS BIGINT) AS "pay_W" FROM settled GROUP BY ALL""", dt="race_date", ctes=PICKS)
def _(spark, sf):
    return pk.annotate_payouts(picks(spark, sf), b.payouts(spark, sf))


@query("bin_calibrate_select", """
SELECT bet_type, count(*) FILTER (cal) AS n_cal, count(*) FILTER (NOT cal) AS n_eval,
  count(DISTINCT CASE WHEN g THEN bin END) AS n_profitable_bins,
  count(*) FILTER (NOT cal AND g) AS n_selected, sum(paid) FILTER (NOT cal) / nullif(count(*) FILTER (NOT cal) * max(cost), 0) - 1 AS all_roi,
  sum(paid) FILTER (NOT cal AND g) / nullif(count(*) FILTER (NOT cal AND g) * max(cost), 0) - 1 AS selected_roi,
  count(*) FILTER (NOT cal AND g AND paid > 0) AS selected_hits
FROM (SELECT n.*, good.bin IS NOT NULL AS g FROM binned n LEFT JOIN good ON n.bet_type = good.bet_type AND n.bin = good.bin) GROUP BY 1""",
       dbl="all_roi selected_roi", ctes=CAL)
def _(spark, sf):
    return pk.bin_calibrate_select(picks(spark, sf), b.payouts(spark, sf), CALIBRATION_END)


@query("head_tail_bins", """
WITH stats AS (SELECT greatest(len(list_filter(edges, lambda e: e < conf)), 1) AS bin, count(*) AS n, sum(paid) / (count(*) * 100) - 1 AS roi
  FROM per_race p JOIN all_edges e ON p.bet_type = e.bet_type WHERE p.bet_type = 'SH2' GROUP BY 1)
SELECT CAST(bin AS INT) AS bin, n, roi, CASE WHEN top <= 3 THEN 'best' ELSE 'worst' END AS side FROM (
  SELECT *, row_number() OVER (ORDER BY roi DESC, bin) AS top, row_number() OVER (ORDER BY roi, bin) AS low FROM stats)
WHERE top <= 3 OR low <= 3""", dbl="roi", ctes=CAL)
def _(spark, sf):
    return pk.head_tail_bins(picks(spark, sf), b.payouts(spark, sf), "SH2")


@query("ev_threshold_roi", """
SELECT bet_type, thr AS ev_thr, count(*) AS n, count(*) FILTER (payout > 0) AS hit, sum(payout) / count(*) AS roi_pct FROM (
  SELECT e.bet_type, round(ev * 1e9) / 1e9 AS ev, coalesce(payout, 0) AS payout FROM ev_rows e LEFT JOIN payouts p ON e.race_no = p.race_no
    AND e.bet_type = p.bet_type AND e.kumi_ban = p.kumi_ban), (VALUES (1.0::DOUBLE), (1.2), (1.5)) t(thr) WHERE ev >= thr GROUP BY 1, 2""",
       dbl="ev_thr roi_pct", ctes=EV)
def _(spark, sf):
    from paceline.functions.numeric import settle
    from paceline.operators.market import join_ev
    priced = join_ev(alt_combos(spark, sf), b.market(spark, sf)).withColumn("ev", settle(F.col("ev")))
    return pk.ev_threshold_roi(priced, b.payouts(spark, sf))


@query("ev_offset_grid", """
SELECT target_offset_min, bet_type, thr AS ev_thr, count(*) AS n_bets, count(DISTINCT race_date) AS days, sum(payout) / count(*) AS roi_pct
FROM priced, (VALUES (1.0::DOUBLE), (1.2), (1.5), (2.0)) t(thr) WHERE ev >= thr GROUP BY 1, 2, 3
HAVING count(*) >= 30 AND count(DISTINCT race_date) >= 5""", dbl="target_offset_min ev_thr roi_pct", ctes=GRID)
def _(spark, sf):
    return pk.ev_offset_grid(bets(spark, sf, pk.GRID_THRESHOLDS))


@query("policy_grid", f"""
WITH cells AS (SELECT off AS target_offset_min, bet_type, thr AS ev_thr FROM (VALUES (5.0::DOUBLE), (3.0), (2.0), (1.0), (0.5)) o(off),
  (VALUES ('SH2'), ('ST2')) t(bet_type), (VALUES (1.0::DOUBLE), (1.1), (1.2)) v(thr)),
per_race AS (SELECT target_offset_min, bet_type, thr AS ev_thr, {R}, sum(payout) AS pay, count(*) AS n FROM priced,
  (VALUES (1.0::DOUBLE), (1.1), (1.2)) t(thr) WHERE ev >= thr AND race_date >= DATE '{LOCK_DATE}' AND {COMPLETE} GROUP BY ALL),
stats AS (SELECT target_offset_min, bet_type, ev_thr, count(*) AS n_races, CAST(sum(n) AS BIGINT) AS n_bets,
  count(DISTINCT date_trunc('week', race_date)) AS weeks, sum(pay) / (sum(n) * 100) - 1 AS roi, avg(pay - 100 * n) AS net_mean,
  stddev_samp(pay - 100 * n) AS net_sd FROM per_race GROUP BY 1, 2, 3)
SELECT c.*, coalesce(n_races, 0) AS n_races, coalesce(n_bets, 0) AS n_bets, coalesce(weeks, 0) AS weeks, roi, net_mean, net_sd
FROM cells c LEFT JOIN stats USING (target_offset_min, bet_type, ev_thr)""",
       dbl="target_offset_min ev_thr roi net_mean net_sd", ctes={**GRID, **COMPLETION})
def _(spark, sf):
    return policies(spark, sf)


def policies(spark, sf):
    """The registered policies, on complete races from the lock date on."""
    locked = bets(spark, sf, [1.0, 1.1, 1.2]).where(F.col("race_date") >= F.lit(LOCK_DATE).cast("date"))
    cells = pk.policy_cells(spark, ["SH2", "ST2"], [1.0, 1.1, 1.2], CAPTURE_OFFSETS)
    return pk.policy_grid(locked, cells, qa.complete_races(completion(spark, sf)))


FORWARD_LL = ", ".join(
    f"avg(-(y_{t} * ln(least(greatest(p_{t}, 1e-6), 1 - 1e-6)) + (1 - y_{t}) * ln(1 - least(greatest(p_{t}, 1e-6), 1 - 1e-6)))) AS ll_{t}, "
    f"-(avg(y_{t}) * ln(least(greatest(avg(y_{t}), 1e-6), 1 - 1e-6)) + (1 - avg(y_{t})) * ln(1 - least(greatest(avg(y_{t}), 1e-6), 1 - 1e-6))) AS ll_{t}_base"
    for t in ("win", "top2", "top3"))
FORWARD_HITS = ", ".join(
    f"""avg((payout > 0)::INT) FILTER (bet_type = '{x}') AS "{x}_hit", avg(payout) FILTER (bet_type = '{x}') / 100 AS "{x}_roi" """
    for x in ("SH2", "ST2", "RH3", "RT3"))


@query("forward_metrics", f"""
WITH cars AS (SELECT p.*, coalesce(tyaku = 1, false)::INT AS y_win, coalesce(tyaku BETWEEN 1 AND 2, false)::INT AS y_top2,
  coalesce(tyaku BETWEEN 1 AND 3, false)::INT AS y_top3 FROM predictions p LEFT JOIN results r ON p.race_no = r.race_no AND p.car_no = r.car_no
  WHERE p.race_no IN (SELECT race_no FROM completion WHERE status = 'complete')),
losses AS (SELECT coalesce(strftime(date_trunc('week', race_date), '%Y-%m-%d'), 'total') AS week, count(*) AS n_rows, {FORWARD_LL}
  FROM cars GROUP BY ROLLUP (date_trunc('week', race_date))),
rets AS (SELECT coalesce(strftime(date_trunc('week', race_date), '%Y-%m-%d'), 'total') AS week, count(*) FILTER (bet_type = 'SH2') AS n_races, {FORWARD_HITS}
  FROM settled WHERE bet_type <> 'W' AND {COMPLETE} GROUP BY ROLLUP (date_trunc('week', race_date)))
SELECT * FROM losses LEFT JOIN rets USING (week)""",
       dbl=" ".join(f"ll_{t} ll_{t}_base" for t in ("win", "top2", "top3")) + " " + " ".join(f'"{x}_hit" "{x}_roi"' for x in ("SH2", "ST2", "RH3", "RT3")),
       ctes={**PICKS, **COMPLETION})
def _(spark, sf):
    scored = b.predictions(spark, sf).join(b.results(spark, sf), CAR, "left")
    return pk.forward_metrics(scored, b.payouts(spark, sf), qa.complete_races(completion(spark, sf)))


@query("agg_week_rollup", """
SELECT coalesce(strftime(date_trunc('week', race_date), '%Y-%m-%d'), 'total') AS week, count(*) AS n_bets,
  count(*) FILTER (payout > 0) AS n_hits, sum(payout) / (count(*) * 100) AS ret FROM settled GROUP BY ROLLUP (date_trunc('week', race_date))""",
       dbl="ret", ctes=PICKS)
def _(spark, sf):
    from paceline.operators.aggregates import week_rollup
    paid = pk.settle_tickets(pk.tickets_of(picks(spark, sf)), b.payouts(spark, sf))
    return week_rollup(paid, [F.count(F.lit(1)).alias("n_bets"), F.count(F.when(F.col("payout") > 0, 1)).alias("n_hits"),
                              (F.sum("payout") / (F.count(F.lit(1)) * 100)).alias("ret")])


@query("quinella_pair_frame", f"SELECT {R}, champ_pair, cand_pair, champ_ret, cand_ret FROM pair_frame", dbl="champ_ret cand_ret",
       dt="race_date", ctes=PAIRS)
def _(spark, sf):
    return pk.quinella_pair_frame(duel(spark, sf), b.payouts(spark, sf))


@query("join_champion_common", f"SELECT {R} FROM predictions GROUP BY ALL HAVING count(p_win) >= 2 AND count(p_top2) >= 2", dt="race_date")
def _(spark, sf):
    d = duel(spark, sf)
    return jo.common_races(pk.top_pair(d, "p_champion", "champ"), pk.top_pair(d, "p_candidate", "cand"))


COMPARE = {**PICKS, **{
    "ranked_b": f"""SELECT {R}, list(car_no ORDER BY p_top3 DESC, car_no) AS w, list(car_no ORDER BY p_win DESC, car_no) AS t2,
      list(car_no ORDER BY p_top2 DESC, car_no) AS t3 FROM predictions GROUP BY ALL HAVING count(*) >= 3""",
    "tickets_b": f"""SELECT race_no, bet_type, kumi_ban FROM (SELECT *, CASE WHEN t2[1] <> w[1] THEN t2[1] ELSE t2[2] END AS nd FROM ranked_b),
      LATERAL (VALUES ('SH2', array_to_string(list_sort(t2[1:2]), '=')), ('ST2', concat(w[1], '-', nd)),
      ('RH3', array_to_string(list_sort(t3[1:3]), '=')), ('RT3', array_to_string(w[1:3], '-')),
      ('W', array_to_string(list_sort([t3[1], t3[2]]), '=')), ('W', array_to_string(list_sort([t3[1], t3[3]]), '=')),
      ('W', array_to_string(list_sort([t3[2], t3[3]]), '='))) t(bet_type, kumi_ban)""",
    "bt_a": """SELECT bet_type, count(*) FILTER (payout > 0) / count(*) AS hit_rate, sum(payout) / (count(*) * 100) - 1 AS roi FROM settled GROUP BY 1""",
    "bt_b": """SELECT t.bet_type, count(*) FILTER (payout > 0) / count(*) AS hit_rate, sum(coalesce(payout, 0)) / (count(*) * 100) - 1 AS roi
      FROM tickets_b t LEFT JOIN best_pay p ON t.race_no = p.race_no AND t.bet_type = p.bet_type AND t.kumi_ban = p.kumi_ban GROUP BY 1""",
}}


@query("compare_runs", """
SELECT a.bet_type, a.hit_rate AS hit_rate_base, a.roi AS roi_base, z.hit_rate AS hit_rate_alt, z.roi AS roi_alt,
  z.hit_rate - a.hit_rate AS hit_rate_diff_alt, z.roi - a.roi AS roi_diff_alt FROM bt_a a JOIN bt_b z ON a.bet_type = z.bet_type""",
       dbl="hit_rate_base roi_base hit_rate_alt roi_alt hit_rate_diff_alt roi_diff_alt", ctes=COMPARE)
def _(spark, sf):
    base = b.predictions(spark, sf)
    alt = base.select(*CAR, F.col("p_top3").alias("p_win"), F.col("p_win").alias("p_top2"), F.col("p_top2").alias("p_top3"))
    return pk.compare_runs({"base": base, "alt": alt}, b.payouts(spark, sf))
