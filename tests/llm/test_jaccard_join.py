import itertools
import random
import re

import pytest
from paceline.llm.components import components
from paceline.llm.jaccard_join import frequencies, keep_one, similarity_groups


def grams(text, width):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, width, percent):
    sets = [grams(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    smallest = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            smallest[find(k)] = min(smallest.get(find(k), i), i)
    return sorted(((i, len(sets[k]), smallest.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def got(table, **kw):
    rows = similarity_groups(table, **kw).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


def corpus(seed, docs=150):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(120)] + ["É", "the"]
    texts = []
    for _ in range(docs):
        if texts and rnd.random() < 0.75:
            words = rnd.choice(texts[-20:] + texts[:3]).split()
            for _ in range(rnd.choice([0, 1, 1, 2, 4])):
                if words:
                    words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        else:
            words = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 4, 30, 60, 100]))]
        texts.append(" ".join(words))
    return [(i, rnd.choice([str.upper, str.lower, str])(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("width,threshold,seed", [(3, 0.9, 1), (5, 0.8, 2), (1, 0.5, 3)])
def test_same_components_as_brute_force(docs, width, threshold, seed):
    rows = corpus(seed)
    rnd = random.Random(seed)
    rnd.shuffle(rows)
    assert got(docs(rows), width=width, threshold=threshold) == brute(rows, width, round(100 * threshold))


def test_hub_of_copies_that_are_linked_only_through_it(docs):
    base = [f"h{k}" for k in range(100)]
    rows = [(1000, " ".join(base))]
    for i in range(120):
        words = list(base)
        words[i % 100] = f"x{i}"
        words[(i * 7 + 3) % 100] = f"y{i}"
        rows.append((i, " ".join(words)))
    want = brute(rows, 3, 87)
    assert got(docs(rows), width=3, threshold=0.87) == want


def test_odd_rows(docs):
    rows = [(1, None), (2, ""), (3, "  \t"), (4, "one"), (5, "ONE"), (5, "one"), (None, "one"), (None, None), (7, "a b"), (8, "a  b"),
            (9, "z " * 20_000), (10, "z z z z")]
    assert got(docs(rows), width=3, threshold=0.9) == brute(rows, 3, 90)
    assert got(docs([]), width=3, threshold=0.9) == []
    kept = keep_one(docs(rows), 3, 0.9)
    assert sorted((r.doc_id for r in kept.collect() if r.doc_id is not None)) == [1, 2, 3, 4, 7, 9]
    assert kept.columns == docs([]).columns


def test_frequencies_count_each_text_once(docs):
    table = frequencies(docs([(1, "a b c a b c"), (2, "a b c"), (3, None)]), 3)
    assert table.sum() == 3 + 1 and table.max() == 2


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(8, 30)] + [(3, 3), (50, 40), (40, 50)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(found[k] == 100 for k in range(100, 161)) and all(found[k] == 7 for k in range(7, 30))
    assert found[50] == found[40] == 40 and 3 not in found
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
