import random

import corpus_pipeline
from paceline.llm.decontamination import contaminated
from paceline.llm.exact_dedup import drop_copies
from pyspark.sql import functions as F


def test_entry_has_the_pipeline_and_every_operator():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_duplicates", "decontamination", "packing"]


def test_drop_copies_keeps_one_row_of_each_text(docs):
    rows = [(1, "A b"), (2, "a B"), (3, "c"), (3, "c"), (3, "C"), (None, "a b"), (4, None), (5, "")]
    table = docs(rows)
    kept = drop_copies(table)
    assert kept.columns == table.columns
    assert sorted(((r.doc_id, (r.text or "").lower()) for r in kept.collect()), key=str) == [(2, "a b"), (3, "c"), (5, "")]
    assert drop_copies(docs([])).collect() == []


def test_run_against_brute_force(spark, docs, tmp_path):
    from test_decontamination import brute as leaks
    from test_jaccard_join import brute as near

    rnd = random.Random(9)
    vocabulary = [f"w{k}" for k in range(500)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(k, text(25)) for k in range(6)]
    rows = [(i, text(rnd.choice([6, 40, 90]))) for i in range(240)]
    rows += [(300 + k, rows[k][1].upper()) for k in range(30)]
    for k in range(30, 60):
        words = rows[k][1].split()
        words[len(words) // 2] = "changed"
        rows.append((300 + k, " ".join(words)))
    rows += [(400 + k, text(20) + " " + rnd.choice(items)[1] + " " + text(15)) for k in range(12)]
    bad = {500 + k for k in range(60)}
    rows += [(i, text(12) + ". " + text(4) + " nastyword " + text(3) + ". " + text(9)) for i in sorted(bad)]
    rows += [(900, None), (901, "")]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    labels = spark.createDataFrame([(i, 1, int(i in bad)) for i, _ in rows], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")

    left = [(i, t) for i, t in rows if i not in bad]
    largest = {}
    for i, t in left:
        largest[(t or "").lower()] = max(i, largest.get((t or "").lower(), -1))
    left = [(i, t) for i, t in left if largest[(t or "").lower()] == i]
    component = {i: c for i, _, c in near(left, 5, 80)}
    left = [(i, t) for i, t in left if component[i] in (i, None)]
    hit = {i for i, _ in leaks(left, items)}
    want = {i for i, _ in left if i not in hit}

    out = corpus_pipeline.run(spark, str(tmp_path)).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    assert {r.doc_id for r in out} == want and all(r.n == r["all"] for r in out)
    assert len(hit) >= 10 and contaminated(docs([]), spark.createDataFrame(items, "item_id long, text string")).collect() == []
