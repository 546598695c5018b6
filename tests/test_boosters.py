"""Boosted trees: what they learn, where they stop, both ways to run the steps, and the registered queries."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from paceline.operators import boosting as bo, models as mo
from paceline.plans import models as plans

SMALL = "/root/testdata/sf0.001"


def rows_of(n=2400, seed=4):
    """x decides where it is known, c (a category) where it is not; the last tenth is held out."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        x, c = rng.normal(), str(rng.choice(list("abcd")))
        known = i % 5 > 0
        p = (0.85 if x > 0.3 else 0.1) if known else (0.9 if c in "bd" else 0.05)
        y = int(rng.random() < p)
        out.append((i, float(x) if known else None, c if i % 7 else None, float(rng.normal()), y, 8.0 - 6 * y + float(rng.random()), 0.4 * x, i % 10 == 9))
    return out


@pytest.fixture()
def rows(frame):
    return frame("i long, x double, c string, noise double, y int, r double, off double, held boolean", rows_of())


FITS = [bo.Fit("y", "y", "log", ("x", "c", "noise"), "auc"), bo.Fit("r", "r", "l1", ("x", "c", "noise")),
        bo.Fit("z", "y", "log", ("x", "c"), "loss", "off")]
SHAPE = bo.Shape(rounds=12, depth=3, rate=0.3, patience=4, min_rows=20)


def fitted(rows, shape=SHAPE, fits=FITS):
    return bo.fit_boosters(rows, fits, ["x", "noise"], ["c"], F.col("held"), shape)


def test_both_ways_to_run_the_steps_agree(rows, monkeypatch):
    """Carried margins, levels of sums and one task per fit give the same trees."""
    alone = fitted(rows)
    monkeypatch.setattr(bo, "ONE_TASK_BYTES", 0)
    monkeypatch.setattr(bo, "CARRY", 2)
    steps = fitted(rows, bo.Shape(rounds=5, depth=3, rate=0.3, patience=4, min_rows=20))
    for name, b in steps.items():
        n = min(len(b.history), len(alone[name].history))
        assert n >= 4 and b.history[:n] == pytest.approx(alone[name].history[:n], abs=1e-9)
        for one, two in zip(b.trees, alone[name].trees):
            assert one.feature.tolist() == two.feature.tolist() and one.left.tolist() == two.left.tolist()
            assert one.value == pytest.approx(two.value, abs=1e-9)


def test_boosters_learn_and_give_null_a_side(rows, spark, tmp_path):
    models = fitted(rows)
    bo.save_boosters(models, spark, f"{tmp_path}/m")
    again = bo.load_boosters(spark, f"{tmp_path}/m")
    got = bo.scored(again, rows, ["i"]).toPandas()
    both = bo.scored({"p": again["y"], "e": again["r"]}, rows, ["x", "c", "y", "r"]).toPandas()
    known = both[both.x.notna()]
    assert known[known.x > 0.5].p.mean() > known[known.x < 0].p.mean() + 0.5
    unknown = both[both.x.isna() & both.c.notna()]
    assert unknown[unknown.c.isin(["b", "d"])].p.mean() > unknown[unknown.c.isin(["a", "c"])].p.mean() + 0.4
    assert abs(both.e - both.r).mean() < abs(both.r - both.r.median()).mean() * 0.7
    assert bo.scored(again, rows.limit(0), ["x"]).columns == ["x", *again] and set(again) == set(models) and got.shape[0] == 2400
    gain = again["y"].importance()
    assert gain["x"][0] > gain["c"][0] > gain["noise"][0] and gain["x"][1] >= len(again["y"].trees)


def test_best_split_against_all_splits():
    rng = np.random.default_rng(1)
    hist = np.abs(rng.normal(size=(3, 2, 3, 6))) * 40
    hist[0] -= 30
    got = bo.best_splits(hist, np.array([False, True]), 5, 0.5)
    for node in range(3):
        g, h, n = hist[:, 0, node]
        score = lambda s: g[s].sum() ** 2 / (h[s].sum() + 0.5)
        every = np.arange(6)
        best = 0.0
        for cut in range(1, 6):
            for null in (True, False):
                left = np.array(([0] if null else []) + list(range(1, cut + (0 if null and cut == 0 else 1))))
                right = np.setdiff1d(every, left)
                if len(right) and n[left].sum() >= 5 and n[right].sum() >= 5:
                    best = max(best, score(left) + score(right) - score(every))
        assert got[0, node, 0] == pytest.approx(max(best, got[0, node, 0]), rel=1e-9) and got[0, node, 0] >= best - 1e-9


def test_stop_lies_a_patience_behind_the_best_round(rows):
    out = fitted(rows, bo.Shape(rounds=60, depth=3, rate=0.9, patience=4, min_rows=20))
    for b in out.values():
        best = int(np.argmin(b.history)) + 1
        assert len(b.trees) == best and (len(b.history) == best + 4 or len(b.history) == 60)


def test_odd_inputs_give_the_base(frame):
    schema = "i long, x double, c string, noise double, y int, r double, off double, held boolean"
    same = fitted(frame(schema, [(i, 1.0, "a", 0.0, int(i < 30), 2.0, 0.0, False) for i in range(90)]))
    assert same["y"].trees == [] and sigmoid(same["y"].base) == pytest.approx(1 / 3) and same["r"].base == 2.0
    empty = fitted(frame(schema, []))
    assert all(b.trees == [] for b in empty.values())
    flat = fitted(frame(schema, [(i, float("nan"), None, None, i % 2, 1.0, 0.0, None) for i in range(90)]))
    assert flat["z"].base == 0.0


def sigmoid(z):
    return 1 / (1 + math.exp(-z))


def test_registered_queries_end_with_rows(spark):
    """The registered queries themselves, at their full setting, on the smallest tables."""
    from paceline import plans as package

    queries = package.load().queries
    row = queries["train_targets"](spark, SMALL).first()
    assert row.n > 500 and 0 < row.ll_p_win < 0.7 and 0 < row.mae_rank < 3 and min(row[f"rounds_{y}"] for y in mo.CLF_TARGETS) >= 1
    scores = queries["score_batch"](spark, SMALL)
    assert scores.count() == row.n and scores.where("p_win NOT BETWEEN 0 AND 1 OR pred_rank IS NULL").isEmpty()
    found = queries["feature_importance"](spark, SMALL).collect()
    assert len(found) == len(plans.NUMERIC) + len(plans.CATEGORICAL) and sum(r.total for r in found) == pytest.approx(1)
    assert sum(r.total_splits for r in found) > 0
    assert {r.arm for r in queries["ab_score"](spark, SMALL).collect()} == {"A", "B"}


def test_a_tree_is_walked_node_by_node_as_level_by_level():
    """Blocks hold many rows, so that a tree costs a pass over them per level and not a gather per row."""
    rng = np.random.default_rng(5)
    tree = bo.Tree(4)
    for node in (0, 1, 2, 4, 5, 9, 10, 11):
        tree.feature[node], tree.left[node] = rng.integers(6), rng.integers(1 << 63, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    tree.value[:] = rng.normal(size=len(tree.value))
    x = rng.integers(0, bo.BINS, (6, 3000)).astype(np.uint8)
    assert tree._walked(x).tolist() == tree.leaves(x).tolist()
    wide = np.concatenate([x, x], axis=1)
    assert tree.margins(wide).tolist() == [*tree.margins(x), *tree.margins(x)]


def test_blocks_join_small_batches(rows, monkeypatch):
    layout = bo.layout_of(rows, ["x", "noise"], ["c"])
    args = (rows.repartition(1), layout, ["y"], [], [(0.0, None)], F.col("held"))
    whole = bo._blocks(*args).selectExpr("sum(n) n", "count(*) k", "max(n) m").first()
    spark = rows.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        small = bo._blocks(*args).selectExpr("sum(n) n", "count(*) k", "max(n) m").first()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert small == whole and whole.n == 2400


def same_trees(some, others):
    for name, b in some.items():
        assert len(b.trees) == len(others[name].trees) and b.history == pytest.approx(others[name].history, abs=1e-9)
        for one, two in zip(b.trees, others[name].trees):
            assert one.feature.tolist() == two.feature.tolist() and one.left.tolist() == two.left.tolist()
            assert one.value == pytest.approx(two.value, abs=1e-9) and one.gain == pytest.approx(two.gain, rel=1e-6, abs=1e-6)


def test_tables_beyond_one_task_need_no_job_per_step(rows, monkeypatch):
    """Tasks that hold the rows go through the steps together; a step is a job only where memory does not do."""
    shape = bo.Shape(rounds=4, depth=3, rate=0.3, patience=4, min_rows=20)
    alone = fitted(rows, shape)
    monkeypatch.setattr(bo, "ONE_TASK_BYTES", 0)
    by_steps, called = bo._by_steps, []
    monkeypatch.setattr(bo, "_by_steps", lambda *a: called.append(1) or by_steps(*a))
    same_trees(fitted(rows, shape), alone)
    assert not called
    monkeypatch.setattr(bo, "HELD_BYTES", 0)
    same_trees(fitted(rows, shape), alone)
    assert called == [1]


def test_a_gang_takes_tasks_without_rows(frame, monkeypatch):
    """Equal rows are all dealt to one task; the others hold none and take part all the same."""
    schema = "i long, x double, c string, noise double, y int, r double, off double, held boolean"
    few = frame(schema, [(i, float(i % 2), "a", 0.0, int(i % 2 and i % 5 > 0), 2.0 + i % 2, 0.0, i % 10 > 7) for i in range(400)])
    alone = fitted(few)
    monkeypatch.setattr(bo, "ONE_TASK_BYTES", 0)
    same_trees(fitted(few), alone)
    assert alone["y"].trees


def test_packed_columns_give_the_bins_of_each_feature():
    """Bins counted in packed columns are those of the features, levels not seen before included."""
    layout = bo.Layout(("a", "b", "e"), ("c", "d"), (tuple(range(40)), (0.5,), tuple(range(60))), (("u", "v"), ()))
    rng = np.random.default_rng(3)
    x = np.stack([rng.integers(0, len(e) + 2, 900) for e in layout.edges] + [rng.choice([0, 1, 2, 63], 900), rng.choice([0, 63], 900)]).astype(np.uint8)
    runs = [bo._Run(bo.Fit("p", "y", "log", ("a", "b", "c", "d")), 0, 0, 0.0), bo._Run(bo.Fit("q", "y", "l1", layout.names), 1, 0, 0.0)]
    y, keys = rng.integers(0, 2, (1, 900)).astype(float), rng.integers(0, 1 << 32, 900).astype(np.uint32)
    held = bo._Rows([(x[:, :500], y[:, :500], np.zeros((2, 500)), np.zeros(500, bool), keys[:500]),
                     (x[:, 500:], y[:, 500:], np.zeros((2, 400)), np.zeros(400, bool), keys[500:])], layout, runs, (5, 1, 2))
    assert len(held.columns) < 5
    for at, loss, used in ((0, "log", [0, 1, 3]), (1, "l1", [0, 2, 3, 4])):
        task = {"at": at, "label": 0, "loss": loss, "bag": None}
        held.begin(task, 1.0)
        got, begin = held.histogram(task, [0], held.packs.counters(np.array(used))), 0
        g, h = bo._gradients(loss, np.zeros(900), y[0])
        for f in used:
            bins = held.packs.bins[f]
            want = np.stack([np.bincount(x[f], w, 64) for w in (g, h, np.ones(900))])
            assert got[:, 0, begin : begin + len(bins)] == pytest.approx(want[:, bins]) and want[2, bins].sum() == 900
            begin += len(bins)
