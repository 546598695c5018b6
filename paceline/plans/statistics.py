"""Statistics (2.12) over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.functions.numeric import clip, settle
from paceline.keys import CAPTURE_OFFSETS, CAR, RACE
from paceline.operators import picks as pk, ranks, stats as st
from paceline.operators.features import targets
from paceline.plans import bindings as b
from paceline.plans.picks import COMPLETE, GRID, LOCK_DATE, PAIRS, bets, duel, policies
from paceline.plans.quality import COMPLETION
from paceline.plans.registry import query

R = "race_date, place_code, race_no"
REPLICATES = 2000
SCORED = {
    "scored": """SELECT p.*, coalesce(tyaku = 1, false)::INT AS y_win, coalesce(tyaku BETWEEN 1 AND 2, false)::INT AS y_top2,
      coalesce(tyaku BETWEEN 1 AND 3, false)::INT AS y_top3, coalesce(tyaku, 8) AS y_rank
      FROM predictions p JOIN results r ON p.race_no = r.race_no AND p.car_no = r.car_no""",
}


def scored(spark, sf):
    return targets(b.predictions(spark, sf).join(b.results(spark, sf), CAR))


def draws_sql(source: str, key: str, seed: str, reps: int = REPLICATES) -> str:
    """Poisson weights from the same digests: one row per cluster and replicate with weight > 0."""
    cuts = " + ".join(f"(u >= {c})::INT" for c in st.POISSON_CUTS)
    return f"""SELECT * FROM (SELECT * EXCLUDE (u), {cuts} AS w FROM (SELECT *, blk * 6 + slot AS rep,
      (CAST('0x' || substr(h, CASE WHEN slot < 3 THEN 1 ELSE 17 END, 15) AS BIGINT) >> (slot % 3 * 20)) & 1048575 AS u FROM (
      SELECT *, md5(concat('{seed}|', {key}, '|', blk)) AS h FROM {source},
      (SELECT unnest(range({-(-reps // 6)})) AS blk)), (SELECT unnest(range(6)) AS slot)) WHERE rep < {reps}) WHERE w > 0"""


@query("log_loss", """SELECT count(*) AS n, avg(-(y_win * ln(least(greatest(p_win, 1e-6), 1 - 1e-6))
  + (1 - y_win) * ln(1 - least(greatest(p_win, 1e-6), 1 - 1e-6)))) AS log_loss FROM scored""", dbl="log_loss", ctes=SCORED)
def _(spark, sf):
    return scored(spark, sf).agg(F.count(F.lit(1)).alias("n"), st.log_loss(F.col("y_win"), F.col("p_win")).alias("log_loss"))


@query("brier", "SELECT avg((p_win - y_win) ** 2) AS brier_win, avg((p_top2 - y_top2) ** 2) AS brier_top2 FROM scored",
       dbl="brier_win brier_top2", ctes=SCORED)
def _(spark, sf):
    return scored(spark, sf).agg(st.brier(F.col("y_win"), F.col("p_win")).alias("brier_win"),
                                 st.brier(F.col("y_top2"), F.col("p_top2")).alias("brier_top2"))


@query("mae", f"""SELECT avg(abs(y_rank - rk)) AS mae FROM (SELECT y_rank, row_number() OVER (PARTITION BY {R} ORDER BY p_win DESC, car_no) AS rk
  FROM scored)""", dbl="mae", ctes=SCORED)
def _(spark, sf):
    ranked = ranks.top_k(scored(spark, sf), RACE, [F.desc("p_win"), F.col("car_no")], 9)
    return ranked.agg(st.mae(F.col("y_rank"), F.col("rk")).alias("mae"))


@query("auc", """
SELECT CAST(sum(y_win) AS BIGINT) AS n_pos, CAST(count(*) - sum(y_win) AS BIGINT) AS n_neg,
  (sum(y_win * r) - sum(y_win) * (sum(y_win) + 1) / 2) / (CAST(sum(y_win) AS DOUBLE) * (count(*) - sum(y_win))) AS auc FROM (
  SELECT y_win, rank() OVER (ORDER BY p_win) + (count(*) OVER (PARTITION BY p_win) - 1) / 2 AS r FROM scored)""", dbl="auc", ctes=SCORED)
def _(spark, sf):
    return st.auc(scored(spark, sf), "y_win", "p_win")


@query("ece", f"""
WITH e AS (SELECT list_sort(list_distinct(list_transform(quantile_cont(p_win, [{', '.join(f'{i}/10' for i in range(11))}]),
  lambda x: round(x * 1e9) / 1e9))) AS edges FROM scored),
bins AS (SELECT greatest(len(list_filter(edges, lambda x: x < p_win)), 1) AS bin, count(*) AS n, avg(y_win) AS my, avg(p_win) AS mp
  FROM scored, e GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS n, count(*) AS n_bins, sum(n * abs(my - mp)) / sum(n) AS ece FROM bins""", dbl="ece", ctes=SCORED)
def _(spark, sf):
    return st.ece(scored(spark, sf), "y_win", "p_win")


@query("reliability_table", """SELECT CAST(least(floor(p_win / 0.1), 9) AS BIGINT) AS band, count(*) AS n, avg(p_win) AS mean_p, avg(y_win) AS rate
FROM scored GROUP BY 1""", dbl="mean_p rate", ctes=SCORED)
def _(spark, sf):
    return st.reliability_table(scored(spark, sf), "y_win", "p_win")


# A family of p values per market segment, one test per (segment, venue): share of winners in the
# upper half of the prices.
PVALS = {
    "pvals": """SELECT segment, place_code, round(exp(-abs(avg(total) - 250000) / 10000) * 1e6) / 1e6 AS p
      FROM races GROUP BY 1, 2""",
}


def pvals(spark, sf):
    from paceline.functions.numeric import settle
    p = settle(F.exp(-F.abs(F.avg("total") - 250000) / 10000), 6)
    return b.races(spark, sf).groupBy("segment", "place_code").agg(p.alias("p"))


@query("bh_qvalues", """
SELECT segment, place_code, p, least(min(p * m / i) OVER (PARTITION BY segment ORDER BY i DESC), 1) AS q FROM (
  SELECT *, row_number() OVER (PARTITION BY segment ORDER BY p, place_code) AS i, count(*) OVER (PARTITION BY segment) AS m FROM pvals)""",
       dbl="p q", ctes=PVALS)
def _(spark, sf):
    return st.bh_qvalues(pvals(spark, sf), ["segment"], ["place_code"]).select("segment", "place_code", "p", "q")


@query("bh_rowwise", """
SELECT segment, place_code, p, p <= i / m * 0.5 AS passes FROM (
  SELECT *, row_number() OVER (PARTITION BY segment ORDER BY p, place_code) AS i, count(*) OVER (PARTITION BY segment) AS m FROM pvals)""",
       dbl="p", ctes=PVALS)
def _(spark, sf):
    return st.bh_rowwise(pvals(spark, sf), ["segment"], ["place_code"], q=0.5).select("segment", "place_code", "p", "passes")

P_SQL = """CASE WHEN n_races < 2 OR net_mean IS NULL THEN 1.0 WHEN net_sd IS NULL OR net_sd = 0 THEN CASE WHEN net_mean > 0 THEN 0.0 ELSE 1.0 END
  ELSE greatest(0.0, least(1.0, (1 - CASE WHEN v % 2 = 1 THEN 2 / pi() * (atan(t / sqrt(v)) + t / sqrt(v + t * t) * sqrt(v / (v + t * t)) * sqrt(pi()) / 2
      * coalesce(list_sum(list_transform(range(0, (v - 1) // 2), lambda k: exp(lgamma(k + 1) - lgamma(k + 1.5) + k * ln(v / (v + t * t))))), 0))
    ELSE t / sqrt(v + t * t) / sqrt(pi()) * list_sum(list_transform(range(0, v // 2), lambda k: exp(lgamma(k + 0.5) - lgamma(k + 1) + k * ln(v / (v + t * t)))))
    END) / 2)) END"""


def policy_sql(lock: str) -> str:
    """The policy grid from a lock date on, with the one-sided p value by gamma functions."""
    return f"""SELECT *, {P_SQL} AS p FROM (SELECT *, n_races - 1 AS v, net_mean / (net_sd / sqrt(n_races)) AS t FROM (
SELECT c.*, coalesce(n_races, 0) AS n_races, coalesce(n_bets, 0) AS n_bets, coalesce(weeks, 0) AS weeks, roi, net_mean, net_sd
FROM (SELECT off AS target_offset_min, bet_type, thr AS ev_thr FROM (VALUES (5.0::DOUBLE), (3.0), (2.0), (1.0), (0.5)) o(off),
  (VALUES ('SH2'), ('ST2')) t(bet_type), (VALUES (1.0::DOUBLE), (1.1), (1.2)) v(thr)) c LEFT JOIN (
  SELECT target_offset_min, bet_type, ev_thr, count(*) AS n_races, CAST(sum(n) AS BIGINT) AS n_bets, count(DISTINCT date_trunc('week', race_date)) AS weeks,
    sum(pay) / (sum(n) * 100) - 1 AS roi, avg(pay - 100 * n) AS net_mean, stddev_samp(pay - 100 * n) AS net_sd FROM (
    SELECT target_offset_min, bet_type, thr AS ev_thr, race_date, place_code, race_no, sum(payout) AS pay, count(*) AS n FROM priced,
      (VALUES (1.0::DOUBLE), (1.1), (1.2)) t(thr) WHERE ev >= thr AND race_date >= DATE '{lock}' AND {COMPLETE} GROUP BY ALL) GROUP BY 1, 2, 3) s USING (target_offset_min, bet_type, ev_thr)))"""


@query("t_test_greater", f"SELECT * EXCLUDE (v, t) REPLACE (round(p * 1e7) / 1e7 AS p) FROM ({policy_sql(LOCK_DATE)})", dbl="target_offset_min ev_thr roi net_mean net_sd p", ctes={**GRID, **COMPLETION})
def _(spark, sf):
    return st.t_pvalues(policies(spark, sf)).withColumn("p", settle(F.col("p"), 7))


DAYS = {
    **GRID,
    "days": """SELECT target_offset_min, bet_type, thr AS ev_thr, race_date, count(*) * 100 AS stake, CAST(sum(payout) AS BIGINT) AS ret,
      concat(target_offset_min, '|', bet_type, '|', thr, '|', strftime(race_date, '%Y-%m-%d')) AS k
      FROM priced, (VALUES (1.0::DOUBLE), (1.2), (1.5), (2.0)) t(thr) WHERE ev >= thr GROUP BY ALL""",
}
DAYS["day_draws"] = draws_sql("days", "k", "days")


@query("bootstrap_days", """
SELECT target_offset_min, bet_type, ev_thr, count(*) AS days, sum(ret) / sum(stake) * 100 AS roi, any_value(ci_low) AS ci_low,
  any_value(ci_high) AS ci_high, any_value(p_le100) AS p_le100 FROM days JOIN (
  SELECT target_offset_min, bet_type, ev_thr, quantile_cont(roi, 0.025) AS ci_low, quantile_cont(roi, 0.975) AS ci_high,
    avg((roi <= 100)::INT) AS p_le100 FROM (
    SELECT target_offset_min, bet_type, ev_thr, rep, round(sum(w * ret) / sum(w * stake) * 100 * 1e6) / 1e6 AS roi FROM day_draws GROUP BY ALL)
  GROUP BY ALL) b USING (target_offset_min, bet_type, ev_thr) GROUP BY ALL""",
       dbl="target_offset_min ev_thr roi ci_low ci_high p_le100", ctes=DAYS)
def _(spark, sf):
    return st.bootstrap_days(pk.grid_days(bets(spark, sf, pk.GRID_THRESHOLDS)), pk.GRID, REPLICATES)


CLUSTER = {
    **SCORED,
    "race_ll": f"""SELECT {R}, sum(-(y_win * ln(a) + (1 - y_win) * ln(1 - a))) AS lla, sum(-(y_win * ln(z) + (1 - y_win) * ln(1 - z))) AS llb,
      count(*) AS n, concat(strftime(race_date, '%Y-%m-%d'), '|', place_code, '|', race_no) AS k FROM (
      SELECT *, least(greatest(p_win, 1e-4), 1 - 1e-4) AS a, least(greatest(p_top2, 1e-4), 1 - 1e-4) AS z FROM scored) GROUP BY ALL""",
}
CLUSTER["race_draws"] = draws_sql("race_ll", "k", "races")


@query("bootstrap_race_cluster", """
SELECT (SELECT (sum(lla) - sum(llb)) / sum(n) FROM race_ll) AS delta, (SELECT count(*) FROM race_ll) AS n_races,
  quantile_cont(d, 0.025) AS ci_low, quantile_cont(d, 0.975) AS ci_high FROM (
  SELECT rep, round(sum(w * (lla - llb)) / sum(w * n) * 1e6) / 1e6 AS d FROM race_draws GROUP BY 1)""",
       dbl="delta ci_low ci_high", ctes=CLUSTER)
def _(spark, sf):
    y, eps = F.col("y_win"), 1e-4
    loss = lambda p: F.sum(-(y * F.ln(clip(F.col(p), eps, 1 - eps)) + (1 - y) * F.ln(1 - clip(F.col(p), eps, 1 - eps))))
    races = scored(spark, sf).groupBy(*RACE).agg(loss("p_win").alias("lla"), loss("p_top2").alias("llb"), F.count(F.lit(1)).alias("n"))
    return st.bootstrap_race_cluster(races, REPLICATES)


PAIRED = {
    **PAIRS,
    "pair_rows": f"""SELECT *, concat(strftime(race_date, '%Y-%m-%d'), '|', place_code, '|', race_no) AS k FROM pair_frame
      WHERE champ_ret IS NOT NULL""",
}
PAIRED["pair_draws"] = draws_sql("pair_rows", "k", "pairs")


@query("bootstrap_paired", """
SELECT (SELECT count(*) FROM pair_rows) AS n_bets, (SELECT avg(champ_ret) * 100 FROM pair_rows) AS roi_champion,
  (SELECT avg(cand_ret) * 100 FROM pair_rows) AS roi_candidate, (SELECT avg(cand_ret - champ_ret) * 100 FROM pair_rows) AS roi_delta_pt,
  quantile_cont(d, 0.025) AS roi_ci_low, quantile_cont(d, 0.975) AS roi_ci_high FROM (
  SELECT rep, round(sum(w * (cand_ret - champ_ret)) / sum(w) * 100 * 1e6) / 1e6 AS d FROM pair_draws GROUP BY 1)""",
       dbl="roi_champion roi_candidate roi_delta_pt roi_ci_low roi_ci_high", ctes=PAIRED)
def _(spark, sf):
    return st.bootstrap_paired(pk.quinella_pair_frame(duel(spark, sf), b.payouts(spark, sf)), REPLICATES)
