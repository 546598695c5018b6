import random
import re

import pytest
from paceline.llm.decontamination import contaminated


def grams(text, width=5):
    w = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(docs, items, t=0.8):
    out = {}
    for i, x in docs:
        for j, y in items:
            a, b = grams(x), grams(y)
            if b and len(a & b) >= t * len(b) - 1e-9:
                best = max(out.get((i, j), (0, 0, 0)), (len(a & b) / len(b), len(a & b), len(b)))
                out[(i, j)] = best
    return out


@pytest.fixture()
def run(docs, spark):
    def go(rows, items, **kw):
        table = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, doc_id string")
        got = contaminated(docs(rows), table, **kw).collect()
        assert len({(r.doc_id, r.item_id) for r in got}) == len(got)
        return {(r.doc_id, r.item_id): (r.containment, r.shared, r.item_shingles) for r in got}

    return go


def test_same_as_brute_force(run):
    rnd = random.Random(3)
    vocabulary = [f"w{k}" for k in range(400)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(k, text(n)) for k, n in enumerate([5, 6, 9, 16, 17, 30, 31, 32, 33, 60, 3, 1, 0])] + [(20, None), (3, text(12))]
    rows = []
    for i in range(120):
        words = text(rnd.choice([0, 3, 10, 80, 900])).split()
        for _ in range(rnd.choice([0, 1, 1, 2])):
            passage = rnd.choice(items)[1] or ""
            passage = passage.split()
            for _ in range(rnd.choice([0, 0, 1, 2])):
                if passage:
                    passage[rnd.randrange(len(passage))] = rnd.choice(vocabulary)
            at = rnd.randrange(len(words) + 1)
            words[at:at] = passage
        rows.append((i % 110, rnd.choice([" ", "  ", ", "]).join(words).capitalize()))
    rows += [(500, None), (501, ""), (502, items[10][1]), (None, items[5][1]), (503, items[7][1] + " tail"), (504, "x " * 60_000 + items[8][1])]
    want = brute(rows, items)
    got = run(rows, items)
    assert len(want) > 40 and got == want


def test_empty_sides(run):
    assert run([], [(1, "a b c d e f")]) == {}
    assert run([(1, "a b c d e f")], []) == {}
    assert run([(1, ""), (2, None)], [(1, ""), (2, None)]) == {}
