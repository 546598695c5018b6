"""Slab-wise running totals, ranks and quantiles against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paceline.operators import ordered, ranks, stats as st
from paceline.operators.ordered import distribution, distributions, mean_value, n_values, positions, running, share


def skewed(spark, n=3000, seed=1):
    """A third of the rows sits in one group, and its values repeat."""
    rng = np.random.default_rng(seed)
    g = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 40, n))
    v = np.round(np.where(g == 0, rng.integers(0, 5, n), rng.normal(size=n)), 2)
    rows = [(int(a), float(b), i) for i, (a, b) in enumerate(zip(g, v))]
    return rows, spark.createDataFrame(rows, "g int, v double, id int")


def test_running_folds_match_brute_force(spark):
    rows, df = skewed(spark)
    out = running(df, ["g"], [F.col("v"), F.col("id")], {"total": ("sum", F.col("v")), "low": ("min", F.col("v")), "high": ("max", -F.col("id"))})
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == len(rows)
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))
        acc, low, high = 0.0, np.inf, -np.inf
        for _, v, i in mine:
            acc, low, high = acc + v, min(low, v), max(high, -i)
            r = got[i]
            assert abs(r["total"] - acc) < 1e-9 and r["low"] == low and r["high"] == high
            assert abs(r["total_all"] - sum(x[1] for x in mine)) < 1e-9


def test_positions_are_global_and_dense(spark):
    rows, df = skewed(spark)
    got = positions(df, [], [F.desc("v"), F.col("id")]).select("id", "pos", "pos_all").collect()
    want = {r[2]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[2])))}
    assert {r["id"]: r["pos"] for r in got} == want and {r["pos_all"] for r in got} == {len(rows)}


def test_distribution_is_exact(spark):
    rows, df = skewed(spark)
    qs = {"p25": 0.25, "p50": 0.5, "p95": 0.95, "lo": 0.0, "hi": 1.0}
    out = distribution(df, ["g"], F.col("v"), qs, [n_values().alias("n"), mean_value().alias("m"), share(F.col("v") < 0).alias("neg")])
    got = out.collect()
    assert len(got) == len({r[0] for r in rows})
    for r in got:
        v = np.array([x[1] for x in rows if x[0] == r["g"]])
        for name, p in qs.items():
            assert abs(r[name] - np.quantile(v, p)) < 1e-9
        assert r["n"] == len(v) and abs(r["m"] - v.mean()) < 1e-9 and abs(r["neg"] - (v < 0).mean()) < 1e-9


def test_groups_may_have_helper_like_names(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 1, 4.0)], "_k int, _g int, v double")
    assert distribution(df, ["_k", "_g"], F.col("v"), {"m": 0.5}).first()["m"] == 3.0


def test_quantiles_of_one_value_and_nulls(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (2, None)], "g int, v double")
    rows = distribution(df, ["g"], F.col("v"), {"m": 0.5}).collect()
    assert [(r["g"], r["m"]) for r in rows] == [(1, 2.0)]


def test_quantiles_by_splitting_cells(spark, monkeypatch):
    """Cells that hold several values are split until one value is left."""
    monkeypatch.setattr(ordered, "_ORDERED_ROWS", 1)
    monkeypatch.setattr(ordered, "_FEW_ROWS", 0)
    rng = np.random.default_rng(7)
    near = [(1, float(x)) for x in 1000 + rng.random(300)]
    signs = [(2, float(x)) for x in np.concatenate([-(10.0 ** rng.uniform(-320, 300, 60)), [0.0, -0.0, 5e-324, 1e-323], 10.0 ** rng.uniform(-5, 300, 60)])]
    ends = [(3, float("-inf")), (3, -1.0), (3, 2.0), (3, float("inf"))]
    qs = {f"p{i}": i / 20 for i in range(21)}
    got = {r["g"]: r for r in distribution(spark.createDataFrame(near + signs, "g int, v double"), ["g"], F.col("v"), qs).collect()}
    for g, rows in ((1, near), (2, signs)):
        v = np.array([x[1] for x in rows])
        for name, p in qs.items():
            assert np.isclose(got[g][name], np.quantile(v, p), rtol=1e-12, atol=1e-300)
    r = distribution(spark.createDataFrame(ends, "g int, v double"), [], F.col("v"), {"a": 1 / 3, "b": 2 / 3}).first()
    assert abs(r["a"] + 1) < 1e-9 and abs(r["b"] - 2) < 1e-9


def test_quantiles_of_large_whole_numbers_are_exact(spark, monkeypatch):
    monkeypatch.setattr(ordered, "_ORDERED_ROWS", 1)
    monkeypatch.setattr(ordered, "_FEW_ROWS", 0)
    rows = [(2**60 + i * i,) for i in range(101)]
    r = distribution(spark.createDataFrame(rows, "v long"), [], F.col("v"), {"m": 0.5}, [F.max("v").alias("top")]).first()
    assert r["m"] == float(2**60 + 2500) and r["top"] == 2**60 + 10000


@pytest.mark.parametrize("few", [0, 10**6])
def test_quantiles_of_several_values_share_the_passes(spark, monkeypatch, few):
    monkeypatch.setattr(ordered, "_FEW_ROWS", few)
    rows, df = skewed(spark)
    some = df.withColumn("w", F.when(F.col("id") % 3 == 0, F.abs("v")))
    out = distributions(some, ["g"], {"v": F.col("v"), "w": F.col("w")}, {"v50": ("v", 0.5), "w95": ("w", 0.95), "w10": ("w", 0.1)},
                        [F.count("v").alias("n"), F.count("w").alias("nw"), F.sum("c").alias("rows")])
    for r in out.collect():
        v = np.array([x[1] for x in rows if x[0] == r["g"]])
        w = np.array([abs(x[1]) for x in rows if x[0] == r["g"] and x[2] % 3 == 0])
        assert (r["n"], r["nw"], r["rows"]) == (len(v), len(w), len(v))
        assert abs(r["v50"] - np.quantile(v, 0.5)) < 1e-9
        assert abs(r["w95"] - np.quantile(w, 0.95)) < 1e-9 and abs(r["w10"] - np.quantile(w, 0.1)) < 1e-9


@pytest.mark.parametrize("few", [-1, 10**6])
def test_quantiles_of_no_rows(spark, monkeypatch, few):
    monkeypatch.setattr(ordered, "_FEW_ROWS", few)
    none = spark.createDataFrame([], "g int, v double")
    assert distribution(none, ["g"], F.col("v"), {"m": 0.5}, [n_values().alias("n")]).collect() == []
    assert tuple(distribution(none, [], F.col("v"), {"m": 0.5}, [n_values().alias("n")]).first()) == (None, None)


def test_auc_counts_ties_half(spark):
    rng = np.random.default_rng(3)
    p = np.round(rng.random(400), 1)
    y = (rng.random(400) < p).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)], "p double, y int")
    pos, neg = p[y == 1], p[y == 0]
    want = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert abs(st.auc(df, "y", "p").first()["auc"] - want) < 1e-12


def test_auc_counts_rows_without_a_score(spark):
    """As SQL ranks them: above all scores, with ties among themselves; no arm and no row is left out."""
    rng = np.random.default_rng(8)
    rows = [(g, None if i % 7 == 0 or g == "c" else float("nan") if i % 11 == 0 else float(np.round(rng.random(), 1)), int(rng.random() < 0.4))
            for g in "abc" for i in range(150)]
    got = {r["g"]: r for r in st.auc(spark.createDataFrame(rows, "g string, p double, y int"), "y", "p", ["g"]).collect()}
    place = lambda p: (2, 0.0) if p is None else (1, 0.0) if p != p else (0, p)
    for g in "abc":
        pos, neg = ([place(p) for h, p, y in rows if h == g and y == k] for k in (1, 0))
        want = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
        assert (got[g]["n_pos"], got[g]["n_neg"]) == (len(pos), len(neg)) and abs(got[g]["auc"] - want) < 1e-12


def test_block_split_is_even(spark):
    df = spark.createDataFrame([(f"2026-01-{1 + i % 9:02d}", i % 4, i) for i in range(103)], "race_date string, place_code int, race_no int")
    rows = ranks.block_split(df, 5).orderBy("race_date", "place_code", "race_no").collect()
    assert [r["blk"] for r in rows] == [i * 5 // 103 for i in range(103)]


def test_bh_is_monotone_and_matches_the_known_value(spark):
    df = spark.createDataFrame([(1, i, p) for i, p in enumerate([0.001, 0.04, 0.5, 1.0])], "f int, k int, p double")
    q = [r["q"] for r in st.bh_qvalues(df, ["f"], ["k"]).orderBy("p").collect()]
    assert abs(q[0] - 0.004) < 1e-12 and q == sorted(q) and q[-1] == 1.0


def test_student_tail_known_values(spark):
    # Two-sided 5% points of the t table.
    points = [(1, 12.7062), (2, 4.3027), (5, 2.5706), (30, 2.0423), (1000, 1.9623)]
    rows = [(df, t) for df, t in points] + [(df, -t) for df, t in points] + [(7, 0.0)]
    table = spark.createDataFrame(rows, "df long, t double")
    got = {(r.df, r.t): r.p for r in table.select("df", "t", st.student_tail(F.col("t"), F.col("df")).alias("p")).collect()}
    for df, t in points:
        assert abs(got[df, t] - 0.025) < 1e-4
        assert abs(got[df, -t] - 0.975) < 1e-4
    assert abs(got[7, 0.0] - 0.5) < 1e-12


def test_t_pvalues_special_cases(spark):
    df = spark.createDataFrame([("a", 1, 5.0, None), ("b", 10, 1.0, 0.0), ("c", 10, -1.0, 0.0), ("d", 0, None, None)],
                               "k string, n_races long, net_mean double, net_sd double")
    assert {r["k"]: r["p"] for r in st.t_pvalues(df).collect()} == {"a": 1.0, "b": 0.0, "c": 1.0, "d": 1.0}


def test_poisson_weights_have_mean_and_variance_one(spark):
    keys = spark.range(400).select(F.col("id").cast("string").alias("k"))
    w = st.poisson_weights(keys, F.col("k"), 50, "s").agg(F.sum("w"), F.sum(F.col("w") * F.col("w"))).first()
    n = 400 * 50
    assert abs(w[0] / n - 1) < 0.03 and abs(w[1] / n - (w[0] / n) ** 2 - 1) < 0.05


def test_bootstrap_interval_covers_the_mean(spark):
    rng = np.random.default_rng(5)
    rows = [("2026-01-01", 1, i, float(a), float(a + b)) for i, (a, b) in enumerate(zip(rng.random(400), rng.normal(0.2, 0.5, 400)))]
    df = spark.createDataFrame(rows, "race_date string, place_code int, race_no int, champ_ret double, cand_ret double")
    r = st.bootstrap_paired(df, 300).first()
    se = 100 * np.std([x[4] - x[3] for x in rows], ddof=1) / 20
    assert r["n_bets"] == 400 and r["roi_ci_low"] < r["roi_delta_pt"] < r["roi_ci_high"]
    assert abs((r["roi_ci_high"] - r["roi_ci_low"]) / (2 * 1.96 * se) - 1) < 0.2
