"""Coefficients per month with their resampled interval, and what the registered query covers."""

import numpy as np
import pytest

from paceline.operators import conditional as mo
from paceline.plans import models as plans
from tests.test_market import ANCHOR, market_rows


def brute(races, weights):
    """Newton on plain arrays of (log market, log model, winner)."""
    v = np.array([1.0, 0.0])
    for _ in range(10):
        g, h = np.zeros(2), np.zeros((2, 2))
        for (x, win), w in zip(races, weights):
            p = np.exp(x @ v)
            p /= p.sum()
            mean = p @ x
            g += w * (mean - x[win])
            h += w * ((x * p[:, None]).T @ x - np.outer(mean, mean))
        v = v - np.linalg.solve(h, g)
    return v


def test_interval_covers_the_coefficient_of_each_month(spark, frame):
    rows = market_rows(2400, seed=1, info=0.6)
    hist = mo.monthly_refit(frame(ANCHOR, rows), spark.createDataFrame([], mo.HISTORY), "2026-07", "2026-09-30", replicates=100)
    got = {r["apply_month"]: r for r in hist.collect()}
    assert set(got) == {"2026-08", "2026-09"}
    for month, r in got.items():
        assert r["blend_b_ci_low"] < r["blend_b"] < r["blend_b_ci_high"]
        by = {}
        for day, _, race, _, win, q, m in rows:
            if day < f"{month}-01":
                by.setdefault((day, race), []).append((np.log(q), np.log(m), win))
        races = [(np.array([c[:2] for c in cars]), [c[2] for c in cars].index(1)) for cars in by.values()]
        assert r["train_races"] == len(races)
        assert (r["blend_a"], r["blend_b"]) == pytest.approx(tuple(brute(races, np.ones(len(races)))), abs=1e-6)
        rng = np.random.default_rng(0)
        b = [brute(races, rng.poisson(1, len(races)))[1] for _ in range(12)]
        width = r["blend_b_ci_high"] - r["blend_b_ci_low"]
        assert 0.4 * width < 4 * np.std(b) < 2.5 * width


def test_draws_are_those_of_the_other_resampling(spark, frame):
    from paceline.operators.conditional import poisson_draws
    from paceline.operators.stats import poisson_weights

    races = frame("name string", [(f"2026-07-{d:02d}|{p}|{r}",) for d in range(1, 6) for p in range(3) for r in range(12)])
    names = [r.name for r in races.collect()]
    w = poisson_draws(names, 20, "months")
    want = {(r.name, r.rep): r.w for r in poisson_weights(races, races["name"], 20, "months").collect()}
    assert {(n, k): int(w[i, k]) for i, n in enumerate(names) for k in range(20) if w[i, k]} == want


def test_registered_refit_covers_all_months(spark):
    from paceline import plans as package

    got = package.load().queries["monthly_refit"](spark, "/root/testdata/sf0.001").collect()
    days = plans.b.races(spark, "/root/testdata/sf0.001").selectExpr("min(race_date) lo", "max(race_date) hi").first()
    assert len(got) > 20 and max(r.apply_month for r in got) == f"{days.hi:%Y-%m}"
    for r in got:
        assert r.train_date_max < f"{r.apply_month}-01" and r.train_races >= mo.MIN_TRAIN_RACES
        assert r.blend_b_ci_low < r.blend_b < r.blend_b_ci_high and r.converged and r.unconverged == 0


def test_resamples_from_tables_are_those_of_passes(spark, frame, monkeypatch):
    """Nearly all resamples come from one pass over the races, with the coefficients that passes of their own give."""
    from pyspark.sql import functions as F

    races = mo.race_rows(frame(ANCHOR, market_rows(4000, seed=2, info=0.6)))
    blocks = mo.race_blocks(races, F.when(F.col("race_no") <= 20, 0).otherwise(1), 40, "t")
    points = mo.fit_all(blocks, [mo.Fit(before=1), mo.Fit(before=2)])
    direct = mo.fit_all(blocks, [mo.Fit(p.a, p.b, p.before, r) for p in points for r in range(40)], tol=1e-9)
    passed, passes = [], mo.fit_all
    monkeypatch.setattr(mo, "GRID", 12)
    monkeypatch.setattr(mo, "fit_all", lambda blocks, fits, **kw: passed.extend(fits) or passes(blocks, fits, **kw))
    got = [f for fits in mo.resampled_all(blocks, points, 40) for f in fits]
    assert len(passed) <= 4 and all(f.converged for f in got)
    for one, two in zip(got, direct, strict=True):
        assert (one.n, one.a, one.b) == (two.n, pytest.approx(two.a, abs=1e-8), pytest.approx(two.b, abs=1e-8))
    monkeypatch.setattr(mo, "GRID", 2)
    again = [f for fits in mo.resampled_all(blocks, points, 40) for f in fits]
    assert len(passed) >= 80
    for one, two in zip(again, direct, strict=True):
        assert (one.a, one.b) == (pytest.approx(two.a, abs=1e-6), pytest.approx(two.b, abs=1e-6))
