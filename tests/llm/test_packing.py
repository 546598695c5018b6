import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from paceline.llm import packing
from paceline.llm.packing import balanced, cuts, difference, pack_documents
from paceline.llm.queries import public_tokenizer

TEXTS = ["", None, " ", "a ", " a", "  a", "a  b", "a \n b", "it 's don't we'll  x", "é è\tü  ", "a" * 3000 + " b",
         "<|endoftext|> a <|endoftext|>", "one two. " * 9000, "word " * 700, "x"]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    file = Tokenizer.from_file(public_tokenizer()[0])
    return lambda t: [*file.encode(t or "", add_special_tokens=False).ids, 1]


def test_pieces_tile_documents_and_sequences(docs, reference):
    rnd = random.Random(5)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (3, "again"), (3, "again")]
    rows += [(100 + k, " ".join(rnd.choice(["alpha", "be", "Gamma,", "δ."]) for _ in range(rnd.randrange(3000)))) for k in range(60)]
    got = pack_documents(docs(rows), public_tokenizer()).collect()
    sequences, tiles = defaultdict(list), defaultdict(list)
    ids = defaultdict(list)
    for i, t in rows:
        ids[i].append(reference(t))
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        tiles[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
    want = defaultdict(list)
    for i, texts in ids.items():
        for x in texts:
            want[i] += [(a, n, zlib.crc32(np.array(x[a : a + n], "<u4").tobytes()), len(x)) for a, n in cuts(len(x), 2048, packing.PIECE)]
            assert sum(n for _, n in cuts(len(x), 2048, packing.PIECE)) == len(x)
    assert {i: sorted(v) for i, v in tiles.items()} == {i: sorted(v) for i, v in want.items()}
    tokens = sum(r.length for r in got)
    assert tokens > 0.93 * 2048 * len(sequences)
    assert pack_documents(docs([]), public_tokenizer()).collect() == []


def test_sections_give_the_same_ids(reference, monkeypatch):
    monkeypatch.setattr(packing, "_SECTION", 11)
    encoder = packing.Encoder(*public_tokenizer())
    for t in TEXTS:
        assert [*encoder.encode(t or "").tolist(), 1] == reference(t)


def test_table_texts_match_the_tokenizer(spark, reference):
    encoder = packing.Encoder(*public_tokenizer())
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        assert [*encoder.encode(r.text or "").tolist(), 1] == reference(r.text)


def test_differencing():
    assert sorted(s for s, _ in difference([8, 7, 6, 5, 4], 2)) == [14, 16]
    rnd = random.Random(2)
    for n, k in [(1, 1), (5, 9), (40, 3), (200, 17)]:
        sizes = [rnd.randrange(1, 512) for _ in range(n)]
        sets = difference(sizes, k)
        assert sorted(m for _, part in sets for m in part) == list(range(n)) and len(sets) <= k
        assert all(s == sum(sizes[m] for m in part) for s, part in sets)
    assert difference([], 3) == [] and balanced([], 10) == []
    assert [len(w) for w in balanced([6, 6, 6], 10)] == [1, 1, 1]
