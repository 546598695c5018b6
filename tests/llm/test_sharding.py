import zlib
from collections import defaultdict

from paceline.llm.sharding import rendezvous, shard_documents
from pyspark.sql import functions as F


def test_columns_slots_and_growth(docs):
    rows = [(i, "t" * (i % 7)) for i in range(3000)] + [(None, None), (None, "ü"), (5, "again"), (5, "again")]
    got = shard_documents(docs(rows), [1.0] * 40).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 40) and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(40))
    texts = defaultdict(set)
    for i, t in rows:
        texts[i].add((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())))
    assert all((r["size"], r.text_crc32) in texts[r.doc_id] for r in got)
    moved = sum(r.grown_shard == 40 for r in got)
    assert 30 < moved < 140
    assert shard_documents(docs([]), [1.0] * 3).collect() == []


def test_growth_equals_placing_anew(spark):
    keys = spark.range(2000).withColumnRenamed("id", "k")
    both = rendezvous(keys, F.col("k"), [1.0] * 5, 2.0).join(
        rendezvous(keys, F.col("k"), [1.0] * 5 + [2.0]).select("k", F.col("shard").alias("anew")), "k")
    assert both.where("grown_shard <> anew").count() == 0


def test_weights_are_followed(spark):
    got = rendezvous(spark.range(20_000), F.col("id"), [1.0, 3.0]).groupBy("shard").count().collect()
    share = {r.shard: r["count"] for r in got}
    assert abs(share[1] / 20_000 - 0.75) < 0.02


def test_many_cells_stay_gapless(docs, monkeypatch):
    monkeypatch.setattr("paceline.llm.sharding.SLOT_ROWS", 50)
    got = shard_documents(docs([(i % 900, "a") for i in range(1800)]), [1.0, 1.0]).collect()
    for s in (0, 1):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
