import math
import random

import pytest
from pyspark.sql import functions as F

from paceline.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, anchor long, score long, block string"


def brute(rows, every=10):
    """Straight from the definition, with Python's whole numbers."""
    part = [(i, v, lab, k) for k, (i, v, lab) in enumerate(rows)
            if lab is not None and v is not None and all(x is not None and math.isfinite(x * 256) for x in v)]
    vecs = [[math.floor(x * 256) for x in v] for _, v, _, _ in part]
    far = lambda i: math.inf if i is None else i
    out = []
    for a, (i, _, lab, k) in enumerate(part):
        if i is None or i % every:
            continue
        score = [sum(x * y for x, y in zip(vecs[a], w)) for w in vecs]
        order = sorted(range(len(part)), key=lambda j: (-score[j], far(part[j][0])))
        mates = [j for j in order if part[j][2] == lab and j != a][:5]
        for m in mates:
            hits = [j for j in order if part[j][2] != lab and 30 * score[m] <= 100 * score[j] <= 90 * score[m]][:10]
            out += [(i, part[m][0], r + 1, part[j][0], score[m], score[j]) for r, j in enumerate(hits)]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect()), key=str)


def made(n, seed, labels=4, width=6):
    rnd = random.Random(seed)
    rows = [(i, [rnd.choice([0.25, 0.5, 0.9, 0.1, -0.2]) + rnd.random() / 40 for _ in range(width)], rnd.randrange(labels) if rnd.random() < 0.7 else 0) for i in range(n)]
    return rows


@pytest.mark.parametrize("sizes", [(4096, 512, 32, 64), (16, 4, 2, 2)])
def test_against_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("BLOCK_ROWS", "BLOCK_ANCHORS", "BUNDLE_ROWS", "BUNDLE_ANCHORS"), sizes, strict=True):
        monkeypatch.setattr(H, name, value)
    rows = made(260, 3)
    # Ties, copies with other ids, rows that take no part, a null id, negative scores alone.
    rows += [(1000 + k, rows[k][1], rows[k][2]) for k in range(40)]
    rows += [(2000, [math.nan] * 6, 1), (2010, [math.inf, 0.0, 0.0, 0.0, 0.0, 0.0], 1), (2020, None, 1), (2030, [0.5, None, 0.5, 0.5, 0.5, 0.5], 1), (2040, rows[0][1], None)]
    rows += [(None, rows[5][1], rows[5][2]), (3000, [-5.0] * 6, 7), (3001, [5.0] * 6, 7), (3010, [0.0] * 6, 3)]
    df = spark.createDataFrame([(i, v, lab, 1, 2, "x") for i, v, lab in rows], SCHEMA)
    found = got(H.hard_negatives(df, F.col("vec_id") % 10 == 0))
    assert found == brute(rows) and len(found) > 500


def test_repeated_rows_are_rows_of_their_own(spark):
    rows = made(60, 8, labels=2)
    rows += rows[:12]
    df = spark.createDataFrame([(i, v, lab, 1, 2, "x") for i, v, lab in rows], SCHEMA)
    assert got(H.hard_negatives(df, F.col("vec_id") % 10 == 0)) == brute(rows)


def test_large_components_and_lengths_stay_exact(spark):
    rows = [(0, [2.0**50, 3.0], 0), (1, [2.0**50 - 1, 1.0], 0), (2, [2.0**49, 5.0, 9.0], 1), (3, [1.5 * 2.0**49], 1), (4, [], 1), (10, [0.5, 0.5], 1)]
    scaled = [(i, [x / 256 / 2**22 for x in v], lab) for i, v, lab in rows]
    df = spark.createDataFrame([(i, v, lab, 1, 2, "x") for i, v, lab in scaled], SCHEMA)
    want = brute([(i, v + [0.0] * (3 - len(v)), lab) for i, v, lab in scaled])
    assert got(H.hard_negatives(df, F.col("vec_id") % 10 == 0)) == want and want


def test_empty_inputs(spark):
    for rows in ([], [(1, [1.0], 1)], [(10, [1.0], 1)], [(10, None, None)]):
        df = spark.createDataFrame([(i, v, lab, 1, 2, "x") for i, v, lab in rows], SCHEMA)
        out = H.hard_negatives(df, F.col("vec_id") % 10 == 0)
        assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and out.collect() == []
