import hashlib
import random
from collections import defaultdict

from paceline.llm.exact_dedup import directory, exact_dedup, owned_by
from pyspark.sql import functions as F


def fold(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[fold(t)].append(i)
    return {t: (max((x for x in ids if x is not None), default=None), len(ids)) for t, ids in groups.items()}


def check(docs, rows, **kw):
    got = exact_dedup(docs(rows), **kw).collect()
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in brute(rows).items()}
    kept = defaultdict(int)
    for r in got:
        assert (r.keep_id, r.group_size) == by_sha[r.text_sha256]
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert all(kept[s] == 1 for s in by_sha)
    return got


def test_groups_match_brute_force(docs):
    rnd = random.Random(1)
    texts = ["", None, "É", "é", "Straße A", "straße a", "x" * 200_000, "İ", *[f"t{k}" for k in range(40)]]
    check(docs, [(i, rnd.choice(texts)) for i in range(300)], capacity=4)


def test_hot_group_repeats_nulls_and_empty(docs):
    rows = [(i, "Hot") for i in range(50)] + [(7, "hot"), (7, "hot"), (None, "solo"), (None, "HOT"), (99, None), (100, "")]
    got = check(docs, rows)
    assert {r.keep_id for r in got if r.group_size == 53} == {49}
    assert exact_dedup(docs([])).collect() == []


def test_directory_covers_every_key_once(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    near = spark.range(1000).select((F.col("id") + (1 << 62)).alias("key"))
    skewed = keys.union(near).union(near.limit(1))
    slots = directory(skewed, capacity=300)
    rows = slots.collect()
    assert max(r.local_depth for r in rows) > 50 > 6 > min(r.local_depth for r in rows)
    sizes = owned_by(skewed, slots).groupBy("bucket").count().collect()
    assert sum(r["count"] for r in sizes) == 6001 and max(r["count"] for r in sizes) <= 300
    one = spark.range(500).select(F.lit(7).cast("long").alias("key"))
    assert [r.n for r in directory(one, capacity=10).collect()] == [500]
