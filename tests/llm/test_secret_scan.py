import hashlib
import random

from paceline.llm.secret_scan import candidates, corpus_words, secret_scan, transition_model


def corpus(seed=1, docs=150):
    rnd = random.Random(seed)
    prose = ["the", "house", "stands", "near", "river", "internationalization", "counterrevolutionary", "words", "Straße"]
    hexes = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    rows, truth = [], {}
    for i in range(docs):
        words = [rnd.choice(prose) for _ in range(60)]
        for _ in range(2):
            at = rnd.randrange(1, len(words) - 1)
            kind = rnd.randrange(4)
            new, secret = [
                (["AKIA" + "".join(rnd.choice("ABCDEFGHJKLMNPQRSTUVWXYZ234567") for _ in range(16))], True),
                (["token", "=", f'"{hexes(40)}"'], True),
                (["".join(rnd.choice("0123456789") for _ in range(16))], False),
                (["internationalization-house_river"], False),
            ][kind]
            words[at:at] = new
            truth[i, "".join(c for c in new[-1] if c != '"')] = secret
        rows.append((i, " ".join(words)))
    return rows, truth


def test_secrets_are_told_from_numbers_and_words(docs):
    rows, truth = corpus()
    got = secret_scan(docs(rows)).collect()
    by = {(r.doc_id, r.found_sha256): r for r in got}
    for (i, text), secret in truth.items():
        assert by[i, hashlib.sha256(text.encode()).hexdigest()].is_secret == secret
    assert len(by) == len(truth) and all(0 <= r.probability <= 1 for r in got)


def test_given_labels_are_learnt(spark, docs):
    rows, truth = corpus(2)
    found = secret_scan(docs(rows)).select("doc_id", "word_no", "nth", "found_sha256").collect()
    sha = {(i, hashlib.sha256(t.encode()).hexdigest()): s for (i, t), s in truth.items()}
    # The other way round: numbers and words are the findings.
    labels = [(r.doc_id, r.word_no, r.nth, int(not sha[r.doc_id, r.found_sha256])) for r in found if r.doc_id < 100]
    got = secret_scan(docs(rows), spark.createDataFrame(labels, "doc_id long, word_no int, nth int, label int")).collect()
    assert all(r.is_secret != sha[r.doc_id, r.found_sha256] for r in got if r.doc_id >= 100)


def test_odd_rows(docs):
    odd = [(1, None), (2, ""), (2, "   "), (None, "key=" + "a1b2" * 10), (3, "x" * 100_000 + "1"), (4, "ordinary words only"), (5, "A" * 20 + " " + "ä" * 40)]
    got = secret_scan(docs(odd)).collect()
    assert sorted(str(r.doc_id) for r in got) == ["3", "5", "None"] and not any(r.is_secret for r in got)
    assert secret_scan(docs([])).collect() == []
    found = candidates(docs([(1, "a b=c1d2e3f4g5h6i7j8k9,z9y8x7w6v5u4t3s2r1 q")])).collect()
    assert [(r.word_no, r.nth, r.found, r.before, r.after) for r in found] == [
        (2, 0, "c1d2e3f4g5h6i7j8k9", "a", "q"), (2, 1, "z9y8x7w6v5u4t3s2r1", "a", "q")]


def test_corpus_counts(docs):
    words = corpus_words(docs([(1, "The the THE cat"), (2, None), (3, "cat at")]))
    assert {r.word: r.n for r in words.collect()} == {"the": 3, "cat": 2}
    import math

    pairs = {r.pair: r.logp for r in transition_model(words).collect()}
    assert pairs.keys() == {"th", "he", "ca", "at"} and all(math.isclose(p, 0, abs_tol=1e-12) for p in pairs.values())
