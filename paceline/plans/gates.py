"""Gates (2.14) over the driver tables; one run per venue."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.functions.numeric import settle
from paceline.operators import gates as ga, market as mk, picks as pk, quality as qa, stats as st
from paceline.plans import bindings as b
from paceline.plans.market import WEDGE
from paceline.plans.picks import GRID, LOCK_DATE, PAIRS, duel, policies
from paceline.plans.quality import COMPLETION, completion
from paceline.plans.registry import query
from paceline.plans.statistics import REPLICATES, SCORED, draws_sql, policy_sql, scored

R = "race_date, place_code, race_no"
END = "2001-07-31"
OOS_START = "2000-01-01"
MIN_SETTLED = 150

GATE = {
    **WEDGE, **COMPLETION,
    "w4": f"SELECT *, CAST(floor(datediff('day', race_date, DATE '{END}') / 7) AS BIGINT) AS week FROM wedges WHERE bet_type IN ('SH2', 'ST2', 'RH3', 'RT3')",
    "l4": f"SELECT *, CAST(floor(datediff('day', race_date, DATE '{END}') / 7) AS BIGINT) AS week FROM capture_log WHERE status = 'ok'",
    "spine": f"""SELECT * FROM (SELECT DISTINCT target_offset_min FROM capture_log WHERE race_date BETWEEN DATE '{END}' - 27 AND DATE '{END}'),
      (SELECT unnest(range(4)) AS week)""",
    "shared": f"""SELECT s.target_offset_min, bool_and(coalesce(settled, 0) >= {MIN_SETTLED} AND coalesce(coalesce(ok_races, 0) / planned, 0) >= 0.98
        AND coalesce(post_start, 0) = 0 AND coalesce(lag_null, 1) <= 0.5 AND coalesce(lag_p95, 1e9) <= 10) AS shared_pass,
        CAST(sum(coalesce(settled, 0)) AS BIGINT) AS settled FROM spine s
      LEFT JOIN (SELECT CAST(floor(datediff('day', race_date, DATE '{END}') / 7) AS BIGINT) AS week, count(DISTINCT race_no) AS planned FROM runners GROUP BY 1) p ON s.week = p.week
      LEFT JOIN (SELECT target_offset_min, week, count(DISTINCT race_no) AS ok_races, count(*) FILTER (seconds_before_start < 0) AS post_start,
        avg((capture_lag_sec IS NULL)::INT) AS lag_null, quantile_cont(abs(capture_lag_sec), 0.95) AS lag_p95 FROM l4 GROUP BY 1, 2) c
        ON s.target_offset_min = c.target_offset_min AND s.week = c.week
      LEFT JOIN (SELECT target_offset_min, week, count(DISTINCT race_no) AS settled FROM w4 GROUP BY 1, 2) t
        ON s.target_offset_min = t.target_offset_min AND s.week = t.week GROUP BY 1""",
    "bet_gate": """SELECT s.target_offset_min, x.bet_type, bool_and(coalesce(abs(med) <= 0.01 AND p90 <= 0.05 AND s10 <= 0.05, false)) AS bet_pass
      FROM spine s CROSS JOIN (VALUES ('SH2'), ('ST2'), ('RH3'), ('RT3')) x(bet_type)
      LEFT JOIN (SELECT target_offset_min, week, bet_type, quantile_cont(wedge, 0.5) AS med, quantile_cont(abs(wedge), 0.9) AS p90,
        avg((abs(wedge) > 0.1)::INT) AS s10 FROM w4 GROUP BY ALL) m ON s.target_offset_min = m.target_offset_min AND s.week = m.week AND x.bet_type = m.bet_type
      GROUP BY 1, 2""",
    "gate_rows": f"""SELECT target_offset_min, bet_type, bet_pass, shared_pass AND missing_14d = 0 AS shared_pass, settled, missing_14d,
      shared_pass AND missing_14d = 0 AND bet_pass AS verdict FROM bet_gate JOIN shared USING (target_offset_min),
      (SELECT count(*) AS missing_14d FROM completion WHERE race_date BETWEEN DATE '{END}' - 13 AND DATE '{END}' AND status LIKE 'missing%')""",
}


def gate(spark, sf):
    wedges = mk.settlement_wedge(b.market_by_offset(spark, sf), b.payouts(spark, sf))
    missing = qa.completion_missing(completion(spark, sf), "2001-07-18", END, "2001-08-01")
    return ga.gate_timing(b.runners(spark, sf), b.capture_log(spark, sf), wedges, missing, END, MIN_SETTLED)


@query("gate_timing", "SELECT * FROM gate_rows", dbl="target_offset_min", ctes=GATE)
def _(spark, sf):
    return gate(spark, sf)


@query("gate_timing_count", "SELECT count(*) FILTER (verdict) AS n_pass, count(*) AS n_all FROM gate_rows", ctes=GATE)
def _(spark, sf):
    return ga.gate_timing_count(gate(spark, sf))


POLICY = ["target_offset_min", "bet_type", "ev_thr", "n_races", "n_bets", "weeks", "roi", "net_mean", "net_sd"]


STRATEGY_SQL = f"""
WITH tested AS (SELECT *, row_number() OVER (ORDER BY p, target_offset_min, bet_type, ev_thr) AS i, count(*) OVER () AS m FROM ({policy_sql(LOCK_DATE)})),
adjusted AS (SELECT *, least(1.0, min(p * m / i) OVER (ORDER BY i DESC)) AS q FROM tested)
SELECT {", ".join(POLICY)}, round(p * 1e7) / 1e7 AS p, round(q * 1e7) / 1e7 AS q, verdict_a AS a_pass,
  CASE WHEN NOT coalesce(verdict_a, false) THEN 'reference_only' WHEN n_races < 200 OR weeks < 4 THEN 'accumulating'
    WHEN roi > 0 AND q < 0.10 THEN 'candidate' ELSE 'fail' END AS verdict
FROM adjusted LEFT JOIN (SELECT target_offset_min, bet_type, verdict AS verdict_a FROM gate_rows) USING (target_offset_min, bet_type)"""


def judged_policies(spark, sf):
    return ga.policy_verdicts(policies(spark, sf), gate(spark, sf))


@query("gate_strategy", STRATEGY_SQL, dbl="target_offset_min ev_thr roi net_mean net_sd p q", ctes={**GRID, **GATE})
def _(spark, sf):
    judged = judged_policies(spark, sf)
    return judged.select(*POLICY, settle(F.col("p"), 7).alias("p"), settle(F.col("q"), 7).alias("q"), "a_pass", "verdict")


SUNSET = {**GRID, **GATE, "judged": STRATEGY_SQL}


@query("sunset_rules", """
SELECT today, any_pass AS candidate_found, today >= DATE '1999-01-01' + 84 AND n_pass = 0 AS gate_a_due,
  NOT any_pass AND fewest >= 1000 AS count_stop, NOT any_pass AND today >= DATE '1999-01-01' + 182 AS deadline_stop
FROM (SELECT DISTINCT CAST(date_trunc('week', race_date) AS DATE) AS today FROM races),
  (SELECT bool_or(verdict = 'candidate') AS any_pass, min(n_races) AS fewest FROM judged), (SELECT count(*) FILTER (verdict) AS n_pass FROM gate_rows)""",
       dt="today", ctes=SUNSET)
def _(spark, sf):
    from paceline.functions.moments import monday_of
    reports = b.races(spark, sf).select(monday_of(F.col("race_date")).alias("today")).distinct()
    passed = ga.gate_timing_count(gate(spark, sf)).select("n_pass").scalar()
    return ga.sunset_rules(reports, judged_policies(spark, sf), passed, "1999-01-01")


EDGES = ", ".join(f"{i}/10" for i in range(11))


def _metric_sql(p: str, where: str) -> str:
    return f"""SELECT place_code AS run, auc, logloss, ece FROM (
      SELECT place_code, (sum(y_win * r) - sum(y_win) * (sum(y_win) + 1) / 2) / (CAST(sum(y_win) AS DOUBLE) * (count(*) - sum(y_win))) AS auc,
        avg(-(y_win * ln(q) + (1 - y_win) * ln(1 - q))) AS logloss FROM (
        SELECT place_code, y_win, least(greatest({p}, 1e-6), 1 - 1e-6) AS q, rank() OVER (PARTITION BY place_code ORDER BY {p})
          + (count(*) OVER (PARTITION BY place_code, {p}) - 1) / 2 AS r FROM scored WHERE {where}) GROUP BY 1) JOIN (
      SELECT place_code, sum(n * abs(my - mp)) / sum(n) AS ece FROM (
        SELECT s.place_code, greatest(len(list_filter(edges, lambda x: x < {p})), 1) AS bin, count(*) AS n, avg(y_win) AS my, avg({p}) AS mp FROM scored s JOIN (
          SELECT place_code, list_sort(list_distinct(list_transform(quantile_cont({p}, [{EDGES}]), lambda x: round(x * 1e9) / 1e9))) AS edges
          FROM scored WHERE {where} GROUP BY 1) e ON s.place_code = e.place_code WHERE {where} GROUP BY 1, 2) GROUP BY 1) USING (place_code)"""


RUNS = {
    **SCORED,
    "new_m": _metric_sql("p_win", "race_date >= DATE '2000-01-01'"),
    "old_m": _metric_sql("p_top2", "race_date < DATE '2000-01-01'"),
    "same_m": _metric_sql("p_top2", "race_date >= DATE '2000-01-01'"),
    "ages": "SELECT place_code AS run, CAST(datediff('day', max(race_date), DATE '2001-08-20') AS INT) AS champion_age_days FROM races WHERE priority = '1-URGENT' AND status = 'F' GROUP BY 1",
    "cross_runs": """SELECT n.run, n.auc AS new_auc, n.logloss AS new_logloss, n.ece AS new_ece, o.auc AS old_auc, o.logloss AS old_logloss, o.ece AS old_ece
      FROM new_m n JOIN old_m o USING (run)""",
    "same_runs": """SELECT n.run, n.auc AS new_auc, n.logloss AS new_logloss, n.ece AS new_ece, o.auc AS old_auc, o.logloss AS old_logloss, o.ece AS old_ece,
      champion_age_days FROM new_m n JOIN same_m o USING (run) JOIN ages USING (run)""",
}


def _chain(lim: dict) -> str:
    def worse(k):
        return (f"new_auc - old_auc < -{lim['auc_' + k]} OR new_logloss / old_logloss > {lim['ll_' + k]} OR new_ece - old_ece > {lim['ece_' + k]}")
    return f"CASE WHEN new_auc < 0.65 THEN 'NG' WHEN {worse('ng')} THEN 'NG' WHEN {worse('warn')} THEN 'WARN' ELSE 'OK' END"


def metrics(df, p, prefix=""):
    """AUC, log loss and calibration error per run (venue)."""
    runs = df.withColumnRenamed("place_code", "run")
    a = st.auc(runs, "y_win", p, ["run"]).select("run", F.col("auc").alias(f"{prefix}auc"))
    ll = runs.groupBy("run").agg(st.log_loss(F.col("y_win"), F.col(p)).alias(f"{prefix}logloss"))
    e = st.ece(runs, "y_win", p, by=["run"]).select("run", F.col("ece").alias(f"{prefix}ece"))
    return a.join(ll, "run").join(e, "run")


def split(df, later: bool):
    day = F.lit(OOS_START).cast("date")
    return df.where(F.col("race_date") >= day if later else F.col("race_date") < day)


def runs(spark, sf, same: bool):
    """Candidate and champion metrics per venue."""
    s = scored(spark, sf)
    new, old = metrics(split(s, True), "p_win", "new_"), metrics(split(s, same), "p_top2", "old_")
    return new.join(old, "run")


RUN_DBL = "new_auc new_logloss new_ece old_auc old_logloss old_ece"


@query("gate_adopt_cross", f"SELECT *, verdict <> 'NG' AS adopt FROM (SELECT *, {_chain(ga.CROSS)} AS verdict FROM cross_runs)", dbl=RUN_DBL, ctes=RUNS)
def _(spark, sf):
    return ga.gate_adopt_cross(runs(spark, sf, same=False))


def ages(spark, sf):
    r = b.races(spark, sf).where((F.col("priority") == "1-URGENT") & (F.col("status") == "F"))
    return r.groupBy(F.col("place_code").alias("run")).agg(
        F.datediff(F.lit("2001-08-20").cast("date"), F.max("race_date")).alias("champion_age_days"))


@query("gate_adopt_same", f"""SELECT *, verdict = 'OK' OR (verdict = 'WARN' AND champion_age_days >= 28) AS adopt FROM (
  SELECT *, {_chain(ga.SAME)} AS verdict FROM same_runs)""", dbl=RUN_DBL, ctes=RUNS)
def _(spark, sf):
    return ga.gate_adopt_same(runs(spark, sf, same=True).join(ages(spark, sf), "run"))


VETO = {
    **PAIRS,
    "pair_rows": f"""SELECT *, concat(strftime(race_date, '%Y-%m-%d'), '|', place_code, '|', race_no) AS k FROM pair_frame WHERE champ_ret IS NOT NULL""",
    "veto": """SELECT *, CASE WHEN n_bets < 200 THEN 'SKIP' WHEN roi_delta_pt <= -10 AND roi_ci_high < 0 THEN 'NG' WHEN roi_delta_pt <= -5 THEN 'WARN' ELSE 'OK' END AS verdict
      FROM (SELECT place_code, count(*) AS n_bets, avg(champ_ret) * 100 AS roi_champion, avg(cand_ret) * 100 AS roi_candidate,
        avg(cand_ret - champ_ret) * 100 AS roi_delta_pt FROM pair_rows GROUP BY 1) JOIN (
      SELECT place_code, quantile_cont(d, 0.025) AS roi_ci_low, quantile_cont(d, 0.975) AS roi_ci_high FROM (
        SELECT place_code, rep, round(sum(w * (cand_ret - champ_ret)) / sum(w) * 100 * 1e6) / 1e6 AS d FROM pair_draws GROUP BY 1, 2) GROUP BY 1) USING (place_code)""",
}
VETO["pair_draws"] = draws_sql("pair_rows", "k", "pairs")
VETO_DBL = "roi_champion roi_candidate roi_delta_pt roi_ci_low roi_ci_high"


def veto(spark, sf):
    frame = pk.quinella_pair_frame(duel(spark, sf), b.payouts(spark, sf))
    return ga.gate_roi_veto(frame, by=["place_code"], replicates=REPLICATES)


@query("gate_roi_veto", "SELECT * FROM veto", dbl=VETO_DBL, ctes=VETO)
def _(spark, sf):
    return veto(spark, sf)


@query("attention_level", f"""
SELECT run, c.verdict, v.verdict AS roi_verdict, CASE WHEN c.verdict = 'NG' OR v.verdict = 'NG' THEN 'NG' WHEN c.verdict = 'WARN' OR v.verdict = 'ERROR' THEN 'WARN'
  ELSE 'none' END AS attention FROM (SELECT run, {_chain(ga.CROSS)} AS verdict FROM cross_runs) c JOIN veto v ON c.run = v.place_code""",
       ctes={**RUNS, **VETO})
def _(spark, sf):
    roi = veto(spark, sf).select(F.col("place_code").alias("run"), F.col("verdict").alias("roi_verdict"))
    judged = ga.gate_adopt_cross(runs(spark, sf, same=False)).select("run", "verdict")
    return ga.attention_level(judged.join(roi, "run"))


@query("champion_rescore", """
SELECT run, train_end, coalesce(n, 0) AS n, refused, CASE WHEN refused IS NULL THEN auc END AS auc, CASE WHEN refused IS NULL THEN logloss END AS logloss,
  CASE WHEN refused IS NULL THEN ece END AS ece FROM (SELECT *, CASE WHEN train_end >= DATE '2000-01-01' THEN 'trained_on_window' WHEN coalesce(n, 0) = 0 THEN 'no_rows' END AS refused
  FROM (SELECT place_code AS run, min(race_date) + 1800 + 2 * place_code AS train_end FROM races GROUP BY place_code) LEFT JOIN
    (SELECT place_code AS run, count(*) AS n FROM scored WHERE race_date >= DATE '2000-01-01' GROUP BY 1) USING (run) LEFT JOIN same_m USING (run))""",
       dbl="auc logloss ece", dt="train_end", ctes=RUNS)
def _(spark, sf):
    s = split(scored(spark, sf), True)
    champs = b.races(spark, sf).groupBy(F.col("place_code").alias("run")).agg(
        F.min("race_date").alias("d")).select("run", F.date_add("d", 1800 + 2 * F.col("run")).alias("train_end"))
    return ga.champion_rescore(s.withColumnRenamed("place_code", "run"), champs, OOS_START, metrics(s, "p_top2"))
