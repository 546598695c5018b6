"""Market probabilities, combinations, conditional logit (fixtures F2, F12, F13)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paceline.keys import RACE
from paceline.operators.boosting import Shape
from paceline.operators import combos as co, features as fe, market as mk, models as mo

ODDS = "race_date date, place_code int, race_no long, bet_type string, kumi_ban string, odds double"


def st2(n=5, odds=20.0):
    return [("2026-01-01", 11, 1, "ST2", f"{i}-{j}", odds) for i in range(1, n + 1) for j in range(1, n + 1) if i != j]


def test_uniform_market_gives_equal_shares(frame):
    rows = mk.devig_first_marginal(frame(ODDS, st2())).collect()
    assert len(rows) == 5 and all(abs(r["mkt_win"] - 0.2) < 1e-12 for r in rows)
    assert mk.devig_first_marginal(frame(ODDS, st2()[:-1])).count() == 0
    assert mk.devig_first_marginal(frame(ODDS, st2()[:-1]), complete=False).count() == 5
    sh2 = [("2026-01-01", 11, 1, "SH2", f"{i}={j}", 10.0) for i in range(1, 6) for j in range(i + 1, 6)]
    rows = mk.devig_contains_marginal(frame(ODDS, sh2)).collect()
    assert len(rows) == 5 and all(abs(r["mkt_top2"] - 0.4) < 1e-12 for r in rows)


def test_harville_masses_are_one(frame):
    p = frame("race_date date, place_code int, race_no long, car_no int, p_win double",
              [("2026-01-01", 1, 1, c, v) for c, v in ((1, 0.5), (2, 0.3), (3, 0.2))])
    combos = co.harville_pairs(p)
    mass = {r["bet_type"]: r["s"] for r in combos.groupBy("bet_type").agg(F.sum("p_combo").alias("s")).collect()}
    assert abs(mass["ST2"] - 1) < 1e-12 and abs(mass["SH2"] - 1) < 1e-12
    got = {(r["bet_type"], r["kumi_ban"]): r["p_combo"] for r in combos.collect()}
    assert abs(got["ST2", "2-1"] - 0.3 * 0.5 / 0.7) < 1e-12 and len(got) == 9


def test_degenerate_races_are_skipped(frame):
    p = frame("race_date date, place_code int, race_no long, car_no int, p_win double",
              [("2026-01-01", 1, 1, 1, 1.0), ("2026-01-01", 1, 2, 1, 0.0), ("2026-01-01", 1, 2, 2, 0.0),
               ("2026-01-01", 1, 3, 1, 1.0), ("2026-01-01", 1, 3, 2, 0.0)])
    got = {(r["race_no"], r["bet_type"], r["kumi_ban"]): r["p_combo"] for r in co.harville_pairs(p).collect()}
    assert got == {(3, "ST2", "2-1"): 0.0, (3, "SH2", "1=2"): 0.0}


def test_lines_from_positions(frame):
    rows = [("2026-01-01", 1, 1, c, x, 0) for c, x in ((1, 1), (5, 2), (2, 3), (3, 5), (4, 7))]
    narabi = frame("race_date date, place_code int, race_no long, car_no int, narabi_x int, narabi_y int", rows)
    got = {r["car_no"]: (r["line_size"], r["line_pos"]) for r in fe.reconstruct_lines(narabi).collect()}
    assert got == {1: (3, 1), 5: (3, 2), 2: (3, 3), 3: (1, 1), 4: (1, 1)}
    split = frame("race_date date, place_code int, race_no long, car_no int, narabi_x int, narabi_y int",
                  [("2026-01-01", 1, 1, 1, 1, 0), ("2026-01-01", 1, 1, 2, 2, 1)])
    assert {r["line_size"] for r in fe.reconstruct_lines(split).collect()} == {1}


def market_rows(n_races, seed=0, info=0.0, start="2026-07-01"):
    """Known truth: p ∝ q^1.15 · exp(info·z); the model sees z, the market only q."""
    rng = np.random.default_rng(seed)
    rows = []
    first = np.datetime64(start)
    for r in range(n_races):
        q = rng.gamma(1.2, size=7) + 0.05
        q /= q.sum()
        z = rng.normal(size=7)
        t = q**1.15 * np.exp(info * z)
        t /= t.sum()
        win = rng.choice(7, p=t)
        m = q * np.exp(0.5 * z)
        m /= m.sum()
        day = str(first + r // 30)
        rows += [(day, 11, r % 30 + 1, c + 1, int(c == win), float(q[c]), float(m[c])) for c in range(7)]
    return rows


ANCHOR = "race_date date, place_code int, race_no long, car_no int, win int, mkt_win double, p_win double"


def test_fit_recovers_the_exponent(frame):
    races = mo.race_rows(frame(ANCHOR, market_rows(1500)))
    alpha = mo.cond_logit_fit(races, with_model=False).first()
    assert abs(alpha["a"] - 1.15) < 0.08 and alpha["b"] == 0.0
    r = mo.bootstrap_coef(races, replicates=40).first()
    assert abs(r["b"]) < 0.15 and r["b_ci_low"] < 0 < r["b_ci_high"]
    at = lambda a, b: mo.cond_logit_nll(races, a, b).first()["nll"]
    best = mo.cond_logit_fit(races).first()
    assert best["nll"] <= min(at(1, 0), at(0, 1), at(alpha["a"], 0)) + 1e-9


def test_monthly_coefficients_use_earlier_data_only(spark, frame):
    df = frame(ANCHOR, market_rows(2400, seed=1, info=0.6))
    empty = spark.createDataFrame([], mo.HISTORY)
    hist = mo.monthly_refit(df, empty, "2026-07", "2026-09-30", replicates=0)
    rows = {r["apply_month"]: r for r in hist.collect()}
    assert set(rows) == {"2026-08", "2026-09"}
    for m, r in rows.items():
        assert r["train_date_max"] < f"{m}-01" and r["blend_b"] > 0
    again = mo.monthly_refit(df, hist.withColumn("alpha", F.lit(9.0)), "2026-07", "2026-09-30", replicates=0)
    assert {r["alpha"] for r in again.collect()} == {9.0}
    total = mo.forward_eval_monthly(df, hist).where("month = 'total'").first()
    assert total["rl_blend"] < total["rl_mkt"] and total["n_races"] == 1470


def test_blend_follows_the_informative_side(frame):
    rng = np.random.default_rng(7)
    mkt = rng.uniform(0.05, 0.6, 3000)
    mdl = np.clip(mkt + rng.normal(0, 0.15, 3000), 0.01, 0.95)
    y = (rng.random(3000) < mkt).astype(int)
    df = frame("race_date date, place_code int, race_no long, m double, k double, y int",
               [("2026-01-01", 1, i, float(a), float(b), int(c)) for i, (a, b, c) in enumerate(zip(mdl, mkt, y))])
    c = mo.blend_logit(df, "m", "k", "y")
    assert c["coef_market"] > c["coef_model"]
    p = [r[0] for r in df.select(mo.apply_blend("m", "k", c)).collect()]
    assert 0 < min(p) and max(p) < 1


def test_trees_learn_and_route_missing_values(frame):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(1500):
        x = rng.normal()
        y = int(rng.random() < (0.8 if x > 0 else 0.1))
        rows.append((f"2026-01-{1 + i % 28:02d}", 1, i, 1, None if i % 10 == 0 else float(x), "a" if i % 2 else None, y, y, y, 1 if y else 8))
    df = frame("race_date date, place_code int, race_no long, car_no int, x double, c string, y_win int, y_top2 int, y_top3 int, y_rank int", rows)
    models = mo.train_targets(df, ["x"], ["c"], Shape(rounds=3, depth=2, rate=0.5))
    out = mo.score_batch(models, df, [*RACE, "car_no", "x"])
    lo, hi = (out.where(w).agg(F.avg("p_win")).first()[0] for w in ("x < -0.5", "x > 0.5"))
    assert hi > lo + 0.3 and {"p_win", "p_top2", "p_top3", "pred_rank"} <= set(out.columns) and out.count() == 1500
    imp = mo.feature_importance(df.sparkSession, models, ["x", "c"]).orderBy(F.desc("total")).first()
    assert imp["feature"] == "x"
    ab = mo.ab_score(models["y_win"], models["y_win"], df).collect()
    assert len(ab) == 2 and abs(ab[0]["auc"] - ab[1]["auc"]) < 1e-12


@pytest.mark.parametrize("with_model", [True, False])
def test_fit_survives_separation(frame, with_model):
    rows = [("2026-01-01", 1, r, c, int(c == 1), 0.4 if c == 1 else 0.3, 0.4 if c == 1 else 0.3) for r in range(20) for c in (1, 2, 3)]
    f = mo.cond_logit_fit(mo.race_rows(frame(ANCHOR, rows)), with_model).first()
    assert np.isfinite(f["a"]) and np.isfinite(f["nll"])
