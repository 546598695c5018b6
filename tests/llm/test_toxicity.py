import random

import numpy as np
import pyarrow as pa
import pytest
from paceline.llm import toxicity as T


@pytest.fixture()
def corpus(spark, docs):
    rnd = random.Random(4)
    bad = ["vilex", "grubby", "rotter"]
    words = [f"w{k}" for k in range(200)]
    rows, labels, truth = [], [], {}
    for i in range(900):
        parts = [" ".join(rnd.choice(words) for _ in range(8)) for _ in range(rnd.randrange(1, 12))]
        truth[i] = rnd.random() < 0.2
        if truth[i]:
            k = rnd.randrange(len(parts))
            parts[k] = parts[k] + " " + rnd.choice(bad)
        rows.append((i, ". ".join(parts)))
        labels.append((i, None, int(truth[i]), "clash"))
    labels += [(None, 1, 1, ""), (5, 1, None, ""), (10**9, 1, 1, "")]
    return docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string"), truth


def test_held_out_documents_are_told_apart(corpus):
    docs, labels, truth = corpus
    got = T.toxicity(docs, labels).collect()
    assert len(got) == len(truth) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out]
    assert 150 < len(held) < 300
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    texts = {r.doc_id: r.text for r in docs.collect()}
    hits = [r for r in held if r.predicted and truth[r.doc_id]]
    blamed = [any(b in texts[r.doc_id][r.offending[0].begin :].split(".")[0] for b in ("vilex", "grubby", "rotter")) for r in hits]
    assert np.mean(blamed) > 0.95
    clean = T.drop_toxic(docs, labels)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in got if not r.predicted}


def test_labels_of_held_out_rows_do_not_matter(corpus):
    docs, labels, _ = corpus
    flipped = labels.withColumn("toxic", T.F.when(T.held_out(T.F.col("doc_id")), 1 - T.F.col("toxic")).otherwise(T.F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in T.toxicity(docs, x).collect()} for x in (labels, flipped))
    assert a == pytest.approx(b, abs=1e-9)


def test_odd_rows_and_missing_labels(spark, docs):
    odd = docs([(1, None), (1, None), (2, ""), (None, "a. b! c"), (3, "x " * 50_000), (4, "...")])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = T.toxicity(odd, none).collect()
    assert len(got) == 6 and all(r.score == 0 and r.predicted == 0 for r in got)
    assert T.toxicity(docs([]), none).collect() == []
    one = spark.createDataFrame([(2, 1, 1), (4, 1, 1)], "doc_id long, quality int, toxic int")
    assert all(r.score == 0 for r in T.toxicity(odd, one).collect() if r.n_sentences == 0)


def test_sentences_and_noisy_or():
    bags = T.sentences(pa.array(["One two. Three three!", None, "", "no end", "..."]))
    assert bags.owner.tolist() == [0, 0, 3] and bags.begin.tolist() == [0, 9, 0]
    # A word and two beginnings each; the repeated word counts once.
    assert np.bincount(bags.sentence).tolist() == [6, 3, 6]
    p = np.array([0.2, 0.5, 0.9])
    got = T.noisy_or(np.log(p / (1 - p)), np.array([0, 0, 2]), 3)
    assert got == pytest.approx([1 - 0.8 * 0.5, 0, 0.9])


def test_screen_keeps_what_toxic_documents_share():
    texts = ["good vilex day", "vilex again", "plain vilex", "good day", "good night", "plain day", "again night", "day night"] * 4
    toxic = np.array([1, 1, 1, 0, 0, 0, 0, 0] * 4)
    bags = T.sentences(pa.array(texts))
    kept = set(T.screened(T.by_document(bags), toxic, 3.0).tolist())
    (hashes, *_), _, _ = T.W.located_words(pa.array(["vilex day"]), T.W.alphanumeric(), T.PREFIXES)
    vilex, day = (hashes & np.uint64((1 << T.FEATURE_BITS) - 1)).tolist()
    assert vilex in kept and day not in kept
    assert len(T.screened(iter([]), np.zeros(0), 3.0)) == 0
