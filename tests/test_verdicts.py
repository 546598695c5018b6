"""Return veto, settlement, forward metrics, policies and adoption (fixtures F5-F8, F14)."""

import datetime as dt

import math
import numpy as np
import pytest
from pyspark.sql import functions as F

from paceline.functions.text import pair_of
from paceline.operators import gates as ga, picks as pk
from paceline.operators.dedup import select_official

RACE = "race_date date, place_code int, race_no long"
CAR = f"{RACE}, car_no int"
DUEL = f"{CAR}, p_champion double, p_candidate double, is_win int, odds double"


def duel(frame, returns):
    """Two rows per race: car 1 is the champion's pick, car 2 the candidate's."""
    rows = []
    for i, (champ, cand) in enumerate(returns):
        for car, ret, pc, pn in ((1, champ, 0.9, 0.1), (2, cand, 0.1, 0.9)):
            rows.append(("2026-01-01", 1, i, car, pc, pn, int(ret is None or ret > 0), None if ret is None else (ret or 5.0)))
    return frame(DUEL, rows)


@pytest.mark.parametrize("returns,verdict,delta,n", [
    ([(2.0, 2.0)] * 250, "OK", 0.0, 250), ([(1.07, 1.0)] * 250, "WARN", -7.0, 250), ([(1.2, 0.0)] * 250, "NG", -120.0, 250),
    ([(11.0, 1.0)] * 3 + [(1.0, 1.0)] * 247, "WARN", -12.0, 250), ([(1.2, 0.0)] * 50, "SKIP", -120.0, 50), ([], "SKIP", None, 0),
    ([(2.0, 2.0)] * 209 + [(2.0, None)], "OK", 0.0, 209)])
def test_roi_gate(frame, returns, verdict, delta, n):
    r = ga.evaluate_roi_gate(duel(frame, returns), replicates=200).first()
    assert r["verdict"] == verdict and r["n_bets"] == n
    assert r["roi_delta_pt"] == (None if delta is None else pytest.approx(delta))


def test_roi_gate_missing_column_is_a_value(frame):
    r = ga.evaluate_roi_gate(duel(frame, [(1.0, 1.0)]).drop("odds")).first()
    assert r["verdict"] == "ERROR" and "odds" in r["reason"]


def test_pair_text(spark):
    df = spark.createDataFrame([("1=2",), ("7=2",), ("3-5",), ("4=4",), ("1=2=3",), ("",), (None,)], "t string")
    got = [tuple(r["p"]) if r["p"] else None for r in df.select(pair_of(F.col("t")).alias("p")).collect()]
    assert got == [(1, 2), (2, 7), (3, 5), None, None, None, None]


def quinella(frame, scores, payouts):
    cars = frame(f"{CAR}, p_champion double, p_candidate double", scores)
    pay = frame(f"{RACE}, bet_type string, kumi_ban string, payout int", payouts)
    return {r["race_no"]: (r["champ_ret"], r["cand_ret"]) for r in pk.quinella_pair_frame(cars, pay).collect()}


def test_quinella_settlement(frame):
    p = (0.9, 0.8, 0.1, 0.05)
    cars = lambda no: [("2026-01-01", 1, no, c + 1, p[c], p[3 - c]) for c in range(4)]
    got = quinella(frame, cars(1) + cars(2) + cars(3), [
        ("2026-01-01", 1, 1, "SH2", "1=2", 340), ("2026-01-01", 1, 2, "SH2", "1=2", 100), ("2026-01-01", 1, 2, "SH2", "3=4", 150)])
    assert got == {1: (3.4, 0.0), 2: (1.0, 1.5), 3: (None, None)}


def test_quinella_needs_two_runners_on_both_sides(frame):
    rows = [("2026-01-01", 1, 1, 1, 0.9, 0.9), ("2026-01-01", 1, 2, 1, 0.9, 0.9), ("2026-01-01", 1, 2, 2, 0.8, None)]
    assert quinella(frame, rows, []) == {}


def test_official_rows(frame):
    at = lambda h, m: dt.datetime(2026, 11, 12, h, m)
    rows = [(1, at(7, 30), 0.5, "official"), (1, at(7, 40), 0.4, "official"), (1, at(12, 0), 0.9, "rerun"), (2, at(7, 30), 0.7, "legacy_unverifiable")]
    df = frame(f"{CAR}, predicted_at timestamp_ntz, p_win double, run_type string", [("2026-11-12", 1, 1, c, t, p, k) for c, t, p, k in rows])
    assert [(r["car_no"], r["p_win"]) for r in select_official(df, ["p_win"]).collect()] == [(1, 0.4)]


SCORES = f"{CAR}, p_win double, p_top2 double, p_top3 double, tyaku int"


def scored(frame, p, date="2026-11-16"):
    return frame(SCORES, [(date, 1, 1, i + 1, v, 1.5 * v, min(2 * v, 1.0), i + 1) for i, v in enumerate(p)])


def test_forward_metrics(frame):
    pay = frame(f"{RACE}, bet_type string, kumi_ban string, payout int", [("2026-11-16", 1, 1, "SH2", "1=2", 500)])
    whole = frame(RACE, [("2026-11-16", 1, 1)])
    # A race whose results are not all there yet is no loss.
    both = scored(frame, [0.4, 0.3, 0.1, 0.1, 0.05, 0.05]).unionByName(scored(frame, [0.4, 0.3, 0.1, 0.1, 0.05, 0.05], "2026-11-23"))
    rows = {r["week"]: r for r in pk.forward_metrics(both, pay, whole).collect()}
    assert set(rows) == {"2026-11-16", "total"}
    t = rows["total"]
    assert (t["n_races"], t["SH2_hit"], t["SH2_roi"], t["ST2_hit"]) == (1, 1.0, 5.0, 0.0) and t["ll_win"] < t["ll_win_base"]


def policies(spark, frame, date, complete=True):
    from paceline.keys import CAPTURE_OFFSETS
    from paceline.operators.combos import harville_pairs
    combos = harville_pairs(scored(frame, [0.5, 0.3, 0.1, 0.05, 0.03, 0.02], date).select(
        "race_date", "place_code", "race_no", "car_no", "p_win")).where(F.col("race_date") >= "2026-11-13")
    odds = frame(f"{RACE}, bet_type string, kumi_ban string, odds double, target_offset_min double", [(date, 1, 1, "SH2", "1=2", 9.0, 1.0)])
    pay = frame(f"{RACE}, bet_type string, kumi_ban string, payout int", [(date, 1, 1, "SH2", "1=2", 900)])
    bets = pk.grid_bets(combos, odds, pay, [1.0, 1.1, 1.2])
    whole = frame(RACE, [(date, 1, 1)] if complete else [(date, 1, 2)])
    return pk.policy_grid(bets, pk.policy_cells(spark, ["SH2", "ST2"], [1.0, 1.1, 1.2], CAPTURE_OFFSETS), whole)


def test_thirty_policies(spark, frame):
    gate = spark.createDataFrame([(o, x, False) for o in (5.0, 3.0, 2.0, 1.0, 0.5) for x in ("SH2", "ST2")], "target_offset_min double, bet_type string, verdict boolean")
    rows = ga.policy_verdicts(policies(spark, frame, "2026-11-16"), gate).collect()
    assert len(rows) == 30 and {r["verdict"] for r in rows} == {"reference_only"} and all(r["q"] == 1.0 for r in rows)
    hit = [r for r in rows if (r["target_offset_min"], r["bet_type"], r["ev_thr"]) == (1.0, "SH2", 1.0)][0]
    assert (hit["n_races"], hit["weeks"], hit["roi"]) == (1, 1, 8.0)
    assert sum(r["n_races"] for r in policies(spark, frame, "2026-11-12").collect()) == 0
    assert sum(r["n_bets"] for r in policies(spark, frame, "2026-11-16", complete=False).collect()) == 0


def test_student_tail_against_the_density(spark):
    """Against a fine sum over the density, closed forms for one and two degrees, and symmetry."""
    from paceline.operators.stats import student_tail

    def exact(t, v):
        u = np.linspace(-1, 1, 400_001) * math.atan(t / math.sqrt(v))
        density = np.cos(u) ** (v - 1)
        c = math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(math.pi)
        return 0.5 - c * np.trapezoid(density, u) / 2

    cases = [(t, v) for t in (0.0, 0.3, 1.7, 4.0, 60.0, -2.2) for v in (1, 2, 3, 8, 29, 200, 5000, 400_000)]
    df = spark.createDataFrame([(float(t), v) for t, v in cases], "t double, v long")
    for r in df.select("t", "v", student_tail(F.col("t"), F.col("v")).alias("p")).collect():
        want = 1 - exact(-r.t, r.v) if r.t < 0 else exact(r.t, r.v)
        assert r.p == pytest.approx(want, abs=1e-9)
        if r.v == 1:
            assert r.p == pytest.approx(0.5 - math.atan(r.t) / math.pi, abs=1e-12)
        if r.v == 2:
            assert r.p == pytest.approx(0.5 - r.t / math.sqrt(2 + r.t * r.t) / 2, abs=1e-12)


@pytest.mark.parametrize("a,n,weeks,roi,q,verdict", [
    (False, 500, 9, 1.0, 0.0, "reference_only"), (None, 500, 9, 1.0, 0.0, "reference_only"), (True, 199, 9, 1.0, 0.0, "accumulating"),
    (True, 200, 3, 1.0, 0.0, "accumulating"), (True, 200, 4, 0.1, 0.09, "candidate"), (True, 200, 4, 0.1, 0.10, "fail"), (True, 200, 4, -0.1, 0.0, "fail")])
def test_policy_verdict(spark, a, n, weeks, roi, q, verdict):
    df = spark.createDataFrame([(a, n, weeks, roi, q)], "a_pass boolean, n_races long, weeks long, roi double, q double")
    assert ga.gate_strategy(df).first()["verdict"] == verdict


def test_sunset(spark, frame):
    today = spark.createDataFrame([("2026-12-01",), ("2027-02-06",), ("2027-05-15",)], "d string").select(F.col("d").cast("date").alias("today"))
    pol = spark.createDataFrame([("fail", 10)], "verdict string, n_races long")
    got = {str(r["today"]): (r["gate_a_due"], r["count_stop"], r["deadline_stop"]) for r in ga.sunset_rules(today, pol, F.lit(0), "2026-11-13").collect()}
    assert got == {"2026-12-01": (False, False, False), "2027-02-06": (True, False, False), "2027-05-15": (True, False, True)}


@pytest.mark.parametrize("auc,ll,age,verdict,adopt", [
    (0.8071, 0.3249, 3, "OK", True), (0.8055, 0.3252, 3, "WARN", False), (0.8055, 0.3252, 40, "WARN", True),
    (0.8030, 0.3250, 3, "NG", False), (0.8070, 0.3270, 3, "NG", False), (0.60, 0.33, 3, "NG", False)])
def test_adoption_on_the_same_rows(spark, auc, ll, age, verdict, adopt):
    df = spark.createDataFrame([(auc, ll, 0.008, 0.8070, 0.3250, 0.008, age)],
                               "new_auc double, new_logloss double, new_ece double, old_auc double, old_logloss double, old_ece double, champion_age_days int")
    r = ga.gate_adopt_same(df).first()
    assert (r["verdict"], r["adopt"]) == (verdict, adopt)


def test_first_adoption_has_only_the_floor(spark):
    df = spark.createDataFrame([(0.8, 0.3, 0.01, None, None, None), (0.6, 0.3, 0.01, None, None, None)],
                               "new_auc double, new_logloss double, new_ece double, old_auc double, old_logloss double, old_ece double")
    assert [r["verdict"] for r in ga.gate_adopt_cross(df).collect()] == ["OK", "NG"]


def gate_a(frame, spark, **broken):
    """Four weeks × two offsets, everything in order unless ``broken`` says otherwise."""
    entries, log, wedges = [], [], []
    for d in range(28):
        date = str(dt.date(2026, 11, 30) - dt.timedelta(days=d))
        for n in range(2):
            entries.append((date, 1, n, 1))
            for off in (5.0, 1.0):
                hurt = off == 1.0 and d == 8
                if not (hurt and broken.get("coverage")):
                    lag = 60.0 if broken.get("lag") and off == 1.0 and 7 <= d < 14 else None if broken.get("null") and off == 1.0 and 7 <= d < 14 else 1.0
                    log.append((date, 1, n, off, "ok", -1.0 if hurt and broken.get("late") else 30.0, lag))
                if not (broken.get("settled") and off == 1.0 and 7 <= d < 14):
                    for bet in ("SH2", "ST2", "RH3", "RT3"):
                        wedges.append((date, 1, n, bet, off, 0.2 if broken.get("wedge") and bet == "RT3" and d < 7 and off == 1.0 else 0.001))
    missing = [("2026-11-29", 1, 1)] if broken.get("missing") else []
    rows = ga.gate_timing(
        frame(CAR, entries), frame(f"{RACE}, target_offset_min double, status string, seconds_before_start double, capture_lag_sec double", log),
        frame(f"{RACE}, bet_type string, target_offset_min double, wedge double", wedges), frame(RACE, missing), "2026-11-30", min_settled=14).collect()
    return {(r["target_offset_min"], r["bet_type"]) for r in rows if r["verdict"]}


ALL = {(o, x) for o in (5.0, 1.0) for x in ("SH2", "ST2", "RH3", "RT3")}


@pytest.mark.parametrize("broken,passing", [
    ({}, ALL), ({"coverage": True}, {k for k in ALL if k[0] == 5.0}), ({"late": True}, {k for k in ALL if k[0] == 5.0}),
    ({"lag": True}, {k for k in ALL if k[0] == 5.0}), ({"null": True}, {k for k in ALL if k[0] == 5.0}),
    ({"settled": True}, {k for k in ALL if k[0] == 5.0}), ({"wedge": True}, ALL - {(1.0, "RT3")}), ({"missing": True}, set())])
def test_gate_a_breaks_one_condition_at_a_time(frame, spark, broken, passing):
    assert gate_a(frame, spark, **broken) == passing


def test_picks_break_ties_by_car(frame):
    df = frame(SCORES, [("2026-01-01", 1, 1, c, 0.2, 0.2, 0.2, c) for c in (4, 2, 3, 1)] + [("2026-01-01", 1, 2, c, 0.5, 0.5, 0.5, c) for c in (1, 2)])
    rows = pk.make_picks(df).collect()
    assert len(rows) == 1
    assert tuple(rows[0][c] for c in pk.TICKETS) == ("1=2", "1-2", "1=2=3", "1-2-3", "1=2", "1=3", "2=3")


def test_binning_is_right_closed(spark):
    df = spark.createDataFrame([(x,) for x in (0.5, 1.0, 1.5, 2.0, 3.0, 3.5)], "x double")
    edges = F.array(*[F.lit(e) for e in (1.0, 2.0, 3.0)])
    assert [r[0] for r in df.select(pk.bin_of(F.col("x"), edges)).collect()] == [None, 1, 1, 1, 2, None]
