import random

import pytest
from paceline.llm import suffix_dedup as S
from tests.llm.test_suffix_dedup import brute, corpus, got


@pytest.mark.parametrize("places", [0, 12])
@pytest.mark.parametrize("length,anchor,alphabet,seed", [(50, 32, "abcdefgh é", 1), (12, 7, "ab", 2)])
def test_hot_anchors_give_the_same_as_brute_force(docs, monkeypatch, length, anchor, alphabet, seed, places):
    monkeypatch.setattr(S, "SHARD_BYTES", 1500)
    monkeypatch.setattr(S, "HOT_PLACES", places)
    rnd = random.Random(seed)
    rows = corpus(seed, 60, alphabet, 3 * length)
    line = "".join(rnd.choice("xyz") for _ in range(length + 6))
    near = lambda: "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(length)))
    rows += [(1000 + i if i else None, near() + line + near()) for i in range(40)]
    assert got(docs(rows), length=length, anchor=anchor) == brute(rows, length)


def test_a_hot_anchor_is_not_gathered(docs, monkeypatch):
    """One line with different surroundings in each text: its contexts do not reach the merge."""
    seen = []
    staged = S.staged
    monkeypatch.setattr(S, "staged", lambda df, label: seen.append((label, staged(df, label))) or seen[-1][1])
    monkeypatch.setattr(S, "HOT_PLACES", 100)
    rnd = random.Random(3)
    rows = [(i, rnd.randbytes(40).hex() + "a line of sixty bytes that stands in every text, with care.." + rnd.randbytes(40).hex()) for i in range(300)]
    assert got(docs(rows)) == brute(rows, 50)
    tables = dict(seen)
    assert tables["repeat-bits"].selectExpr("coalesce(max(length(bits)), 0)").first()[0] < 4 * 300
    assert tables["hot-runs"].count() > 0
