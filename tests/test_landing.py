"""Landed tables are bucketed by race; resamples are summed where they are drawn."""

import math

import pytest
from pyspark.sql import functions as F

from paceline.keys import CAR
from paceline.operators import market as mk, stats as st
from paceline.operators.dedup import newest_per_key
from paceline.plans import bindings as b

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wedges_and_returns_move_no_landed_row(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        prices, paid = b.market_by_offset(spark, SF), b.payouts(spark, SF)
        for df in (mk.settlement_wedge(prices, paid), b.results(spark, SF).join(b.runners(spark, SF), CAR)):
            assert "Exchange" not in plan_of(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_line_items_are_not_sorted_in_front_of_the_shuffle(spark):
    plan = plan_of(b.latest_lines(spark, SF))
    assert "Sort" not in plan[plan.rindex("Exchange"):]


def test_newest_row_with_named_and_computed_order(spark):
    rows = spark.createDataFrame([(1, 2, "a", 5.0), (1, 3, "b", None), (1, 3, "c", None), (2, None, "d", 1.0), (2, None, "e", 0.0), (None, 1, "f", 1.0), (None, 1, "f", 1.0)],
                                 "k int, t int, x string, y double")
    want = {(1, 3, "c", None), (2, None, "e", 0.0), (None, 1, "f", 1.0)}
    assert {tuple(r) for r in newest_per_key(rows, ["k"], ["t", "x"]).collect()} == want
    assert {tuple(r) for r in newest_per_key(rows, ["k"], [F.col("t"), F.col("x")]).collect()} == want
    assert newest_per_key(rows, ["k"], ["t", "x"], ["y"]).columns == ["k", "y"]


@pytest.mark.parametrize("replicates", [1, 20])
def test_replicate_sums_are_those_of_the_drawn_weights(spark, replicates):
    rows = [(f"r{i % 40}", None if i % 9 == 0 else i % 3, float(i), None if i % 3 == 0 else i) for i in range(80)] + [(None, 1, 2.5, 4)]
    df = spark.createDataFrame(rows, "k string, g int, x double, n int")
    got = st.replicate_sums(df, F.col("k"), ["g"], {"x": F.col("x"), "n": F.col("n")}, replicates, "s")
    assert "Generate" not in plan_of(got)
    drawn = {(r.k, r.rep): r.w for r in st.poisson_weights(df.select("k").distinct(), F.col("k"), replicates, "s").collect()}
    want = {}
    for k, g, x, n in rows:
        for rep in range(replicates):
            if w := drawn.get((k, rep)):
                t = want.setdefault((g, rep), [0, 0.0, 0.0])
                t[0], t[1], t[2] = t[0] + w, t[1] + w * x, t[2] + w * (n or 0)
    found = {(r.g, r.rep): r for r in got.collect()}
    assert found.keys() == want.keys()
    for at, (w, x, n) in want.items():
        assert found[at]["_weight"] == w and math.isclose(found[at]["x"], x, rel_tol=1e-9)
        assert found[at]["n"] is None if at[0] in (0, None) else math.isclose(found[at]["n"], n, rel_tol=1e-9)
