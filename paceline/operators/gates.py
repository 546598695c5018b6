"""Rule-based gates (2.14): verdict columns on tables of runs, policies and weeks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paceline.functions.numeric import settle
from paceline.keys import RACE
from paceline.operators.ordered import distributions, share
from paceline.operators.stats import bh_qvalues, bootstrap_paired, t_pvalues

# Fixed values of the gates.
GATE_BETS = ["SH2", "ST2", "RH3", "RT3"]
GATE_WEEKS = 4
MIN_SETTLED, MIN_COVERAGE, MAX_LAG_NULL, MAX_LAG_P95 = 150, 0.98, 0.50, 10.0
MAX_MEDIAN, MAX_P90, MAX_SHARE10 = 0.01, 0.05, 0.05
AUC_FLOOR = 0.65
CROSS = {"auc_ng": 0.010, "auc_warn": 0.003, "ll_ng": 1.03, "ll_warn": 1.01, "ece_ng": 0.010, "ece_warn": 0.005}
SAME = {"auc_ng": 0.003, "auc_warn": 0.001, "ll_ng": 1.005, "ll_warn": 1.002, "ece_ng": 0.005, "ece_warn": 0.003}
STALE_DAYS = 28
ROI_MIN_BETS, ROI_NG, ROI_WARN = 200, -10.0, -5.0
POLICY_MIN_RACES, POLICY_MIN_WEEKS, POLICY_Q = 200, 4, 0.10
SUNSET_GATE_WEEKS, SUNSET_FINAL_WEEKS, SUNSET_RACES = 12, 26, 1000


def week_before(end: str) -> Column:
    """0 for the seven days ending at ``end``, 1 for the seven before, …"""
    return F.floor(F.datediff(F.lit(end).cast("date"), "race_date") / 7)


def gate_timing(entries: DataFrame, log: DataFrame, wedges: DataFrame, missing: DataFrame, end: str, min_settled: int = MIN_SETTLED) -> DataFrame:
    """Gate A: per offset and bet type, whether all four weeks pass the shared and the bet rules.

    ``wedges`` holds settled winners with offset, bet type and wedge, ``missing`` the unresolved races
    of the last 14 days.
    """
    weeks = F.col("week").between(0, GATE_WEEKS - 1)
    # The plain date range reaches the scan, where the number of a week could not.
    last = F.lit(end).cast("date")
    days = F.col("race_date").between(F.date_sub(last, 7 * GATE_WEEKS - 1), last)
    in_weeks = lambda df: df.where(days).withColumn("week", week_before(end)).where(weeks)
    key = ["target_offset_min", "week"]
    logged = in_weeks(log)
    ok = logged.where(F.col("status") == "ok")
    measured = in_weeks(wedges.where(F.col("bet_type").isin(GATE_BETS)))
    lag = F.abs("capture_lag_sec")
    lags = distributions(
        ok, key, {"lag": lag, "late": F.when(F.col("seconds_before_start") < 0, 1), "row": F.lit(1)}, {"lag_p95": ("lag", 0.95)},
        [F.count("late").alias("post_start"), (1 - F.count("lag") / F.sum("c")).alias("lag_null")])
    value = settle(F.col("wedge"), 6)
    bets = distributions(
        measured, [*key, "bet_type"], {"v": value, "size": F.abs(value)}, {"median": ("v", 0.5), "p90": ("size", 0.90)},
        [share(F.col("size") > 0.10).alias("share10")])

    # One row per offset, week and race with what is known of it, then one per offset and week.
    fact = lambda df, **flags: df.select(*key, *RACE, *[flags.get(n, F.lit(0)).alias(n) for n in ("ok", "won")])
    races = fact(logged, ok=(F.col("status") == "ok").cast("int")).unionByName(fact(measured, won=F.lit(1)))
    per_race = races.groupBy(*key, *RACE).agg(F.max("ok").alias("ok"), F.max("won").alias("won"), F.min("won").alias("unlogged"))
    caught = per_race.groupBy(*key).agg(F.sum("ok").alias("ok_races"), F.sum("won").alias("settled"), F.min("unlogged").alias("unlogged"))
    planned = in_weeks(entries).groupBy("week").agg(F.countDistinct(*RACE).alias("planned")).agg(
        F.map_from_entries(F.collect_list(F.struct("week", "planned"))))  # an entry per week of the gate
    rows = caught.join(lags, key, "left").withColumn("planned", F.try_element_at(planned.scalar(), F.col("week")))
    lag_null = F.coalesce("lag_null", F.lit(1.0))
    shared = (
        (F.col("settled") >= min_settled) & (F.coalesce(F.try_divide("ok_races", "planned"), F.lit(0.0)) >= MIN_COVERAGE)
        & (F.coalesce("post_start", F.lit(0)) == 0) & (lag_null <= MAX_LAG_NULL) & (F.coalesce("lag_p95", F.lit(1e9)) <= MAX_LAG_P95)
    )
    # A week without rows has not passed; an offset without a log in these weeks, as one retired earlier, is not judged.
    by_offset = rows.groupBy("target_offset_min").agg(
        (F.count(F.when(shared, 1)) == GATE_WEEKS).alias("shared_pass"), F.sum("settled").alias("settled"), F.min("unlogged").alias("unlogged"))
    bet_ok = (F.abs("median") <= MAX_MEDIAN) & (F.col("p90") <= MAX_P90) & (F.col("share10") <= MAX_SHARE10)
    passed = bets.groupBy("target_offset_min", "bet_type").agg((F.count(F.when(bet_ok, 1)) == GATE_WEEKS).alias("bet_pass"))
    gone = missing.agg(F.count(F.lit(1)).alias("missing_14d"))
    judged = by_offset.where(F.col("unlogged") == 0).drop("unlogged").withColumn("bet_type", F.explode(F.array(*[F.lit(x) for x in GATE_BETS])))
    out = judged.join(passed, ["target_offset_min", "bet_type"], "left").withColumn("bet_pass", F.coalesce("bet_pass", F.lit(False)))
    out = out.withColumn("missing_14d", gone.scalar())
    clean = F.col("shared_pass") & (F.col("missing_14d") == 0)
    out = out.withColumn("shared_pass", clean).withColumn("verdict", clean & F.col("bet_pass"))
    return out.select("target_offset_min", "bet_type", "bet_pass", "shared_pass", "settled", "missing_14d", "verdict")


def gate_timing_count(gate: DataFrame) -> DataFrame:
    return gate.agg(F.count(F.when(F.col("verdict"), 1)).alias("n_pass"), F.count(F.lit(1)).alias("n_all"))


def policy_verdicts(policies: DataFrame, gate: DataFrame, key: Sequence[str] = ("target_offset_min", "bet_type", "ev_thr")) -> DataFrame:
    """Gate B: p and q values over all registered policies, then the verdict per policy."""
    tested = bh_qvalues(t_pvalues(policies).withColumn("_family", F.lit(1)), ["_family"], list(key)).drop("_family")
    passed = gate.select("target_offset_min", "bet_type", F.col("verdict").alias("a_pass"))
    return gate_strategy(tested.join(passed, ["target_offset_min", "bet_type"], "left"))


def gate_strategy(policies: DataFrame) -> DataFrame:
    verdict = (
        F.when(~F.coalesce("a_pass", F.lit(False)), "reference_only")
        .when((F.col("n_races") < POLICY_MIN_RACES) | (F.col("weeks") < POLICY_MIN_WEEKS), "accumulating")
        .when((F.col("roi") > 0) & (F.col("q") < POLICY_Q), "candidate").otherwise("fail")
    )
    return policies.withColumn("verdict", verdict)


def sunset_rules(reports: DataFrame, policies: DataFrame, n_gate_pass: Column, lock_date: str) -> DataFrame:
    """Per report day: which of the four end-of-observation messages apply."""
    lock = F.lit(lock_date).cast("date")
    state = policies.agg(F.struct(
        F.bool_or(F.col("verdict") == "candidate").alias("any_pass"), F.min("n_races").alias("fewest"),
        F.count(F.lit(1)).alias("n_policies")).alias("state"))
    df = reports.select("today").withColumn("_state", state.scalar()).select("today", "_state.*")
    none = ~F.coalesce("any_pass", F.lit(False))
    today = F.col("today")
    return df.select(
        "today", (~none).alias("candidate_found"),
        ((today >= F.date_add(lock, 7 * SUNSET_GATE_WEEKS)) & (n_gate_pass == 0)).alias("gate_a_due"),
        (none & (F.col("n_policies") > 0) & (F.col("fewest") >= SUNSET_RACES)).alias("count_stop"),
        (none & (today >= F.date_add(lock, 7 * SUNSET_FINAL_WEEKS))).alias("deadline_stop"))


def _shift(limits: dict[str, float], level: str) -> Column:
    """Any of the three metrics worse than the champion by more than the limit."""
    ratio = F.when(F.col("old_logloss") > 0, F.col("new_logloss") / F.col("old_logloss")).otherwise(F.lit(1.0))
    return (
        (F.col("new_auc") - F.col("old_auc") < -limits[f"auc_{level}"]) | (ratio > limits[f"ll_{level}"])
        | (F.col("new_ece") - F.col("old_ece") > limits[f"ece_{level}"])
    )


def _verdict(limits: dict[str, float], first: Column) -> Column:
    return (
        F.when(F.col("new_auc") < AUC_FLOOR, "NG").when(first, "OK").when(_shift(limits, "ng"), "NG")
        .when(_shift(limits, "warn"), "WARN").otherwise("OK")
    )


def gate_adopt_cross(runs: DataFrame) -> DataFrame:
    """New model against the stored metrics of the champion (another window, wider limits)."""
    out = runs.withColumn("verdict", _verdict(CROSS, F.col("old_auc").isNull()))
    return out.withColumn("adopt", F.col("verdict") != "NG")


def gate_adopt_same(runs: DataFrame) -> DataFrame:
    """Both models on the same rows: a WARN is adopted only if the champion is stale."""
    out = runs.withColumn("verdict", _verdict(SAME, F.lit(False)))
    stale = F.coalesce(F.col("champion_age_days") >= STALE_DAYS, F.lit(False))
    return out.withColumn("adopt", (F.col("verdict") == "OK") | ((F.col("verdict") == "WARN") & stale))


def roi_verdict(tests: DataFrame, min_bets: int = ROI_MIN_BETS) -> DataFrame:
    delta = F.col("roi_delta_pt")
    return tests.withColumn(
        "verdict",
        F.when(F.col("n_bets") < min_bets, "SKIP").when(delta.isNull(), "ERROR")
        .when((delta <= ROI_NG) & (F.col("roi_ci_high") < 0), "NG").when(delta <= ROI_WARN, "WARN").otherwise("OK"))


def race_pair_returns(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Return of the best-scored row of each side per race (price × hit); NULL prices drop the race."""
    scored = df.dropna(subset=["p_champion", "p_candidate"])
    value = F.col("odds").try_cast("double") * F.col("is_win").try_cast("double")
    order = lambda c: F.struct(F.col(c), -F.col("car_no"))
    tops = scored.withColumn("_ret", value).groupBy(*by, *RACE).agg(
        F.max_by("_ret", order("p_champion")).alias("champ_ret"), F.max_by("_ret", order("p_candidate")).alias("cand_ret"))
    return tops.dropna(subset=["champ_ret", "cand_ret"])


def gate_roi_veto(pairs: DataFrame, by: Sequence[str] = (), replicates: int = 2000, min_bets: int = ROI_MIN_BETS) -> DataFrame:
    """Veto on a clear loss of return against the champion, per run."""
    return roi_verdict(bootstrap_paired(pairs, replicates, by=by), min_bets)


def evaluate_roi_gate(df: DataFrame, replicates: int = 2000, min_bets: int = ROI_MIN_BETS) -> DataFrame:
    """The veto for one run as a one-row frame; a missing column is the verdict ERROR."""
    need = {*RACE, "car_no", "p_champion", "p_candidate", "is_win", "odds"}
    lacking = sorted(need - set(df.columns))
    if lacking:
        return df.sparkSession.range(1).select(F.lit("ERROR").alias("verdict"), F.lit(f"missing columns: {', '.join(lacking)}").alias("reason"))
    tested = gate_roi_veto(race_pair_returns(df), replicates=replicates, min_bets=min_bets)
    # Without a race to settle there is no row to judge; a global aggregate gives one either way.
    one = tested.agg(*[F.max(c).alias(c) for c in tested.columns])
    return one.withColumns({"n_bets": F.coalesce("n_bets", F.lit(0)), "verdict": F.coalesce("verdict", F.lit("SKIP"))})


def attention_level(runs: DataFrame) -> DataFrame:
    """Which runs need a person: from the model verdict and the return verdict."""
    v, r = F.col("verdict"), F.coalesce("roi_verdict", F.lit(""))
    return runs.withColumn(
        "attention", F.when((v == "NG") | (r == "NG"), "NG").when((v == "WARN") | (r == "ERROR"), "WARN").otherwise("none"))


def champion_rescore(scored: DataFrame, champions: DataFrame, oos_start: str, metrics: DataFrame) -> DataFrame:
    """Champion metrics on the candidate's rows; refused where the champion has seen the window."""
    rows = scored.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    seen = F.col("train_end") >= F.lit(oos_start).cast("date")
    out = champions.join(rows, "run", "left").join(metrics, "run", "left")
    why = F.when(seen, "trained_on_window").when(F.coalesce("n", F.lit(0)) == 0, "no_rows")
    keep = lambda c: F.when(why.isNull(), F.col(c)).alias(c)
    return out.select("run", "train_end", F.coalesce("n", F.lit(0)).alias("n"), why.alias("refused"), keep("auc"), keep("logloss"), keep("ece"))
