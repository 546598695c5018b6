"""Market probability, expected value and settlement wedge (2.10) over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.functions.numeric import settle
from paceline.keys import CAR, COMBO, RACE
from paceline.operators import combos as co, market as mk
from paceline.operators.dedup import dedup_latest
from paceline.plans import bindings as b
from paceline.plans.registry import query

R = "race_date, place_code, race_no"

EV = {
    # The model under test: Harville on the second score, priced by the market of the first.
    "share_alt": f"""SELECT race_date, place_code, race_no, car_no, p_top2 / s AS q FROM (
      SELECT *, sum(p_top2) OVER w AS s, count(*) OVER w AS n FROM predictions WINDOW w AS (PARTITION BY {R}))
      WHERE s > 0 AND n >= 2""",
    "alt_pairs": """SELECT a.race_date, a.place_code, a.race_no, a.car_no AS i, b.car_no AS j, a.q AS qi, b.q AS qj
      FROM share_alt a JOIN share_alt b ON a.race_no = b.race_no AND a.car_no <> b.car_no""",
    "alt_combos": """SELECT race_date, place_code, race_no, 'ST2' AS bet_type, concat(i, '-', j) AS kumi_ban,
        qi * qj / (1 - qi) AS p_combo FROM alt_pairs WHERE 1 - qi > 0
      UNION ALL SELECT race_date, place_code, race_no, 'SH2', concat(i, '=', j),
        CASE WHEN 1 - qi > 0 THEN qi * qj / (1 - qi) ELSE 0 END + CASE WHEN 1 - qj > 0 THEN qj * qi / (1 - qj) ELSE 0 END
        FROM alt_pairs WHERE i < j""",
    "ev_rows": f"""SELECT m.race_date, m.place_code, m.race_no, m.bet_type, m.kumi_ban, p_combo, odds, p_combo * odds AS ev
      FROM alt_combos c JOIN market m ON c.race_no = m.race_no AND c.bet_type = m.bet_type AND c.kumi_ban = m.kumi_ban""",
}
WEDGE = {
    "wedges": """SELECT m.*, payout / 100 AS realized_odds,
      CASE WHEN m.bet_type = 'W' THEN coalesce((odds + max_odds) / 2, odds) ELSE odds END AS snap_basis,
      round((payout / 100 / CASE WHEN m.bet_type = 'W' THEN coalesce((odds + max_odds) / 2, odds) ELSE odds END - 1) * 1e6) / 1e6 AS wedge
      FROM market_by_offset m JOIN payouts p ON m.race_no = p.race_no AND m.bet_type = p.bet_type AND m.kumi_ban = p.kumi_ban
      WHERE odds > 0""",
}
MARGIN_SIDES = {
    "sides": """SELECT race_date, place_code, race_no, bet_type, 1 / odds AS inv, side,
      CAST(split_part(replace(kumi_ban, '=', '-'), '-', side + 1) AS INT) AS car_no
      FROM market, (VALUES (0), (1)) t(side) WHERE odds > 0""",
}


def alt_combos(spark, sf):
    return co.harville_pairs(b.predictions(spark, sf).select(*CAR, "p_top2"), "p_top2")


def wedges(spark, sf):
    return mk.settlement_wedge(b.market_by_offset(spark, sf), b.payouts(spark, sf))


@query("harville_pairs", f"SELECT {R}, bet_type, kumi_ban, p_combo FROM combos", dbl="p_combo", dt="race_date")
def _(spark, sf):
    return co.harville_pairs(b.predictions(spark, sf).select(*CAR, "p_win"))


@query("self_join_pairs", f"SELECT {R}, i, j, qi AS q_i, qj AS q_j FROM pairs WHERE i < j", dbl="q_i q_j", dt="race_date")
def _(spark, sf):
    q = co.race_share(b.predictions(spark, sf).select(*CAR, "p_win"), "p_win", "q")
    return co.field_pairs(q, ["q"], ordered=False)


@query("combo_mass_check", f"""
SELECT bet_type, quantile_cont(m, 0.5) AS median_mass, avg(m) AS mean_mass FROM (
  SELECT {R}, bet_type, round((sum(p_combo)) * 1e6) / 1e6 AS m FROM combos GROUP BY ALL) GROUP BY 1""", dbl="median_mass mean_mass")
def _(spark, sf):
    return co.combo_mass_check(co.harville_pairs(b.predictions(spark, sf).select(*CAR, "p_win")))


@query("devig_first_marginal", f"""
SELECT {R}, car_no, m / total AS mkt_win FROM (SELECT *, count(*) OVER w AS n, sum(k) OVER w AS t, sum(m) OVER w AS total FROM (
  SELECT {R}, car_no, sum(inv) FILTER (side = 0) AS m, count(*) FILTER (side = 0) AS k FROM sides WHERE bet_type = 'ST2' GROUP BY ALL)
  WINDOW w AS (PARTITION BY {R})) WHERE n >= 5 AND t = n * (n - 1) AND k > 0""",
       dbl="mkt_win", dt="race_date", ctes=MARGIN_SIDES)
def _(spark, sf):
    return mk.devig_first_marginal(b.market(spark, sf))


@query("devig_first_marginal_lenient", f"""
SELECT {R}, car_no, m / sum(m) OVER (PARTITION BY {R}) AS mkt_win FROM (
  SELECT {R}, CAST(split_part(kumi_ban, '-', 1) AS INT) AS car_no, sum(1 / odds) AS m FROM latest_odds WHERE bet_type = 'ST2' GROUP BY ALL)""",
       dbl="mkt_win", dt="race_date")
def _(spark, sf):
    return mk.devig_first_marginal(dedup_latest(b.snapshots(spark, sf), b.SNAP_TIES), complete=False)


@query("devig_contains_marginal", f"""
SELECT {R}, car_no, m / total AS mkt_top2 FROM (SELECT *, count(*) OVER w AS n, sum(k) OVER w AS t, sum(m) OVER w / 2 AS total FROM (
  SELECT {R}, car_no, sum(inv) AS m, count(*) AS k FROM sides WHERE bet_type = 'SH2' GROUP BY ALL)
  WINDOW w AS (PARTITION BY {R})) WHERE n >= 5 AND t = n * (n - 1)""", dbl="mkt_top2", dt="race_date", ctes=MARGIN_SIDES)
def _(spark, sf):
    return mk.devig_contains_marginal(b.market(spark, sf))


@query("join_ev", f"SELECT {R}, bet_type, kumi_ban, p_combo, odds, ev FROM ev_rows", dbl="p_combo odds ev", dt="race_date", ctes=EV)
def _(spark, sf):
    return mk.join_ev(alt_combos(spark, sf), b.market(spark, sf)).select(*COMBO, "p_combo", "odds", "ev")


@query("ev_merge", """
SELECT bet_type, count(*) AS n, avg(ev) AS ev_mean, quantile_cont(ev, 0.5) AS ev_median, avg((ev > 1)::INT) AS share_above_1
FROM (SELECT bet_type, round((ev) * 1e6) / 1e6 AS ev FROM ev_rows) GROUP BY 1""", dbl="ev_mean ev_median share_above_1", ctes=EV)
def _(spark, sf):
    priced = mk.join_ev(alt_combos(spark, sf), b.market(spark, sf))
    return mk.ev_summary(priced)


@query("agg_overround", f"""
SELECT bet_type, count(*) AS n_races, quantile_cont(ov, 0.5) AS overround_median, avg(ov) AS overround_mean,
  (1 - 1 / quantile_cont(ov, 0.5)) * 100 AS implied_takeout_pct FROM (
  SELECT {R}, bet_type, round((sum(1 / odds)) * 1e6) / 1e6 AS ov FROM latest_odds GROUP BY ALL) GROUP BY 1""",
       dbl="overround_median overround_mean implied_takeout_pct")
def _(spark, sf):
    return mk.overround(dedup_latest(b.snapshots(spark, sf), b.SNAP_TIES))


@query("allbuy_roi", f"""
SELECT bet_type, count(*) AS n_races, avg(n_combos) AS avg_n_combos,
  (sum(coalesce(win_payout, 0)) / (sum(n_combos) * 100) - 1) * 100 AS uniform_roi_pct,
  (sum(pool_ret) / count(*) - 1) * 100 AS pool_roi_pct FROM (
  SELECT m.race_no, m.bet_type, count(*) AS n_combos, sum(1 / odds * coalesce(payout, 0) / 100) / sum(1 / odds) AS pool_ret
  FROM market m LEFT JOIN payouts p ON m.race_no = p.race_no AND m.bet_type = p.bet_type AND m.kumi_ban = p.kumi_ban GROUP BY 1, 2) a
LEFT JOIN (SELECT race_no, bet_type, sum(payout) AS win_payout FROM payouts GROUP BY 1, 2) w USING (race_no, bet_type)
GROUP BY 1""", dbl="avg_n_combos uniform_roi_pct pool_roi_pct")
def _(spark, sf):
    return mk.allbuy_roi(b.market(spark, sf), b.payouts(spark, sf))


@query("settlement_wedge", f"SELECT {R}, bet_type, kumi_ban, target_offset_min, snap_basis, realized_odds, wedge FROM wedges",
       dbl="target_offset_min snap_basis realized_odds wedge", dt="race_date", ctes=WEDGE)
def _(spark, sf):
    return wedges(spark, sf).select(*COMBO, "target_offset_min", "snap_basis", "realized_odds", settle(F.col("wedge"), 6).alias("wedge"))


@query("join_settlement", f"""
SELECT m.race_date, m.place_code, m.race_no, m.bet_type, m.kumi_ban, odds, payout FROM latest_odds m JOIN payouts p
  ON m.race_no = p.race_no AND m.bet_type = p.bet_type AND m.kumi_ban = p.kumi_ban""", dbl="odds", dt="race_date")
def _(spark, sf):
    odds = dedup_latest(b.snapshots(spark, sf), b.SNAP_TIES).select(*COMBO, "odds")
    return odds.join(b.payouts(spark, sf), COMBO)


@query("wedge_by_bet_offset", """
SELECT bet_type, target_offset_min, count(*) AS n, quantile_cont(wedge, 0.5) * 100 AS median_wedge_pct,
  avg(wedge) * 100 AS mean_wedge_pct, quantile_cont(wedge, 0.25) * 100 AS p25_pct, quantile_cont(wedge, 0.75) * 100 AS p75_pct,
  avg((abs(wedge) > 0.1)::INT) * 100 AS frac_abs_gt10_pct, avg((abs(wedge) > 0.2)::INT) * 100 AS frac_abs_gt20_pct,
  avg((wedge < 0)::INT) * 100 AS frac_adverse_pct FROM wedges GROUP BY 1, 2""",
       dbl="target_offset_min median_wedge_pct mean_wedge_pct p25_pct p75_pct frac_abs_gt10_pct frac_abs_gt20_pct frac_adverse_pct", ctes=WEDGE)
def _(spark, sf):
    return mk.wedge_by_bet_offset(wedges(spark, sf))


@query("agg_group_stats", """
SELECT target_offset_min, count(*) AS n, quantile_cont(wedge, 0.5) AS median_wedge, avg(wedge) AS mean_wedge,
  quantile_cont(wedge, 0.25) AS p25, quantile_cont(wedge, 0.75) AS p75, avg((wedge < 0)::INT) AS adverse
FROM wedges GROUP BY 1""", dbl="target_offset_min median_wedge mean_wedge p25 p75 adverse", ctes=WEDGE)
def _(spark, sf):
    from paceline.operators.ordered import distribution, mean_value, n_values, share
    return distribution(wedges(spark, sf), ["target_offset_min"], settle(F.col("wedge"), 6),
                        {"median_wedge": 0.5, "p25": 0.25, "p75": 0.75},
                        [n_values().alias("n"), mean_value().alias("mean_wedge"), share(F.col("v") < 0).alias("adverse")])


@query("wedge_by_odds_band", """
SELECT odds_band, count(*) AS n, quantile_cont(wedge, 0.5) * 100 AS median_wedge_pct, avg((wedge < 0)::INT) * 100 AS adverse_pct FROM (
  SELECT wedge, CASE WHEN snap_basis >= 1 AND snap_basis < 3 THEN '1-3' WHEN snap_basis < 1 THEN NULL WHEN snap_basis < 6 THEN '3-6'
    WHEN snap_basis < 10 THEN '6-10' WHEN snap_basis < 20 THEN '10-20' WHEN snap_basis < 50 THEN '20-50'
    WHEN snap_basis < 1e9 THEN '50-+' END AS odds_band FROM wedges
  WHERE target_offset_min = (SELECT max(target_offset_min) FROM wedges)) WHERE odds_band IS NOT NULL GROUP BY 1""",
       dbl="median_wedge_pct adverse_pct", ctes=WEDGE)
def _(spark, sf):
    return mk.wedge_by_odds_band(wedges(spark, sf))


@query("range_containment", """
SELECT count(*) AS n, avg((realized_odds BETWEEN odds AND max_odds)::INT) AS in_range, avg((realized_odds < odds)::INT) AS below_range
FROM wedges WHERE bet_type = 'W' AND max_odds IS NOT NULL""", dbl="in_range below_range", ctes=WEDGE)
def _(spark, sf):
    return mk.range_containment(wedges(spark, sf))


@query("wedge_verdict", """
SELECT *, CASE WHEN abs(median_pct) < 3 AND abs(adverse_pct - 50) < 10 THEN 'pass' ELSE 'caution' END AS verdict FROM (
  SELECT target_offset_min, count(*) AS n, quantile_cont(wedge, 0.5) * 100 AS median_pct, avg((wedge < 0)::INT) * 100 AS adverse_pct
  FROM wedges WHERE target_offset_min = (SELECT max(target_offset_min) FROM wedges) GROUP BY 1)""",
       dbl="target_offset_min median_pct adverse_pct", ctes=WEDGE)
def _(spark, sf):
    return mk.wedge_verdict(wedges(spark, sf))


@query("drift_phase_a", """
SELECT target_offset_min, bet_type, count(*) AS n, quantile_cont(d, 0.5) AS drift_med, quantile_cont(d, 0.25) AS drift_p25,
  quantile_cont(d, 0.75) AS drift_p75, avg((d < -5)::INT) * 100 AS worse_pct FROM (
  SELECT target_offset_min, m.bet_type, round(((payout / 100 / odds - 1) * 100) * 1e6) / 1e6 AS d FROM market_by_offset m JOIN payouts p
  ON m.race_no = p.race_no AND m.bet_type = p.bet_type AND m.kumi_ban = p.kumi_ban) GROUP BY 1, 2""",
       dbl="target_offset_min drift_med drift_p25 drift_p75 worse_pct")
def _(spark, sf):
    return mk.drift_by_offset(b.market_by_offset(spark, sf), b.payouts(spark, sf))


@query("official_lead_bins", f"""
SELECT CASE WHEN d < -10 THEN '<-10' WHEN d < 0 THEN '-10..-1' WHEN d = 0 THEN '0' WHEN d <= 5 THEN '1..5' ELSE '>5' END AS delay,
  count(*) AS n_races FROM (SELECT {R}, CAST(floor((epoch_us(min(snapshot_dt)) - epoch_us(min(start_dt))) / 60000000) AS BIGINT) AS d
  FROM capture_log GROUP BY ALL HAVING min(snapshot_dt) = max(snapshot_dt)) GROUP BY 1""")
def _(spark, sf):
    return mk.official_lead_bins(b.capture_log(spark, sf).withColumnRenamed("snapshot_dt", "official_dt"))


@query("market_health", f"""
SELECT bet_type, target_offset_min, count(DISTINCT ({R})) AS n_races, quantile_cont(wedge, 0.5) * 100 AS median_pct,
  avg((abs(wedge) > 0.1)::INT) * 100 AS gt10_pct, avg((wedge < 0)::INT) * 100 AS adverse_pct
FROM wedges WHERE bet_type <> 'W' GROUP BY 1, 2""", dbl="target_offset_min median_pct gt10_pct adverse_pct", ctes=WEDGE)
def _(spark, sf):
    return mk.health(b.market_by_offset(spark, sf), b.payouts(spark, sf))


@query("market_overround_flag", f"""
SELECT bet_type, n_races, ov AS overround_median, ov NOT BETWEEN 1.25 AND 1.45 AS flagged FROM (
  SELECT bet_type, count(*) AS n_races, quantile_cont(ov, 0.5) AS ov FROM (
    SELECT {R}, bet_type, round((sum(1 / odds)) * 1e6) / 1e6 AS ov FROM market WHERE bet_type <> 'W' GROUP BY ALL) GROUP BY 1)""",
       dbl="overround_median")
def _(spark, sf):
    ov = mk.overround(b.market(spark, sf).where(F.col("bet_type") != "W"))
    return mk.overround_flag(ov).select("bet_type", "n_races", "overround_median", "flagged")
