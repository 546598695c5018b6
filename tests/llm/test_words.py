import pyarrow as pa
import pytest
from paceline.llm import words


@pytest.mark.parametrize("piece", [7, 64, 1 << 20])
def test_words_follow_the_plain_split(monkeypatch, piece):
    monkeypatch.setattr(words, "PIECE", piece)
    texts = ["Hello wOrld  hello", "", None, " a b\tc\x0bd ", "x" * 3000 + " y " + "x" * 3000, "é É hello", "   "]
    got = words.word_hashes(pa.array(texts, pa.string()), words.blank_separated())
    want = [(t or "").encode().lower().split() for t in texts]
    assert [b - a for a, b in zip(got.bounds[:-1], got.bounds[1:], strict=True)] == [len(w) for w in want]
    flat = [x for w in want for x in w]
    seen = dict(zip(flat, got.values.tolist(), strict=True))
    assert [seen[x] for x in flat] == got.values.tolist() and len(set(seen.values())) == len(seen)


def test_shingles_of_short_and_long_texts():
    texts = ["a b c d", "a b", "b c d", "", "a", "b a", "A  B C d"]
    seq = words.shingles(words.word_hashes(pa.array(texts), words.blank_separated()), 3)
    sets = [set(seq.values[a:b].tolist()) for a, b in zip(seq.bounds[:-1], seq.bounds[1:], strict=True)]
    assert [len(s) for s in sets] == [2, 1, 1, 0, 1, 1, 2]
    assert sets[0] == sets[6] and sets[2] < sets[0] and len(sets[1] | sets[4] | sets[5]) == 3


def test_slices_cover_all_rows():
    batch = pa.RecordBatch.from_pydict({"i": list(range(50)), "text": ["x" * (k % 9) for k in range(49)] + [None]})
    parts = list(words.slices(batch, "text", 10))
    assert [i for p in parts for i in p.column("i").to_pylist()] == list(range(50)) and len(parts) > 5
