"""Packing tokenised documents into sequences by Karmarkar-Karp multiway differencing.

A document's ids are cut at fixed places: full windows first, then the rest in equal pieces of at
most ``piece`` ids. A full window is a sequence of its own. The other pieces are dealt out to blocks
by a hash and each block is balanced over as few windows as hold it: partial partitions are merged,
largest difference first, the fullest windows of one with the emptiest of the other, so that the
windows end up nearly equal. If a window exceeds the capacity, the block gets one window more.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paceline.llm import words as W
from paceline.session import staged

CAPACITY = 2048
#: Longest piece of a document's rest: short pieces balance well, long ones keep documents together.
PIECE = 512
#: Pieces that one block balances, about.
BLOCK_PIECES = 768
#: Id behind each document.
END_ID = 1
_SECTION = 1 << 20
_SAFE = re.compile(r"(?<=\S) (?=\S)")


class Encoder:
    """Ids of whole texts, as the tokenizer file ``vocabulary`` gives them without special tokens added.

    ``ranks`` holds the same byte-level BPE as token ranks; a rank encoder is several times faster.
    Texts with the string of a special token go through the tokenizer file itself. The tokenizer
    never joins a blank to the non-blank before it, so long texts are cut at single blanks between
    non-blanks and encoded in sections.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self._file = Tokenizer.from_file(vocabulary)
        self._special = [t.content for t in self._file.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if any(mark in text for mark in self._special):
            return np.array(self._file.encode(text, add_special_tokens=False).ids, np.uint32)
        parts, begin = [], 0
        while begin < len(text):
            cut = _SAFE.search(text, begin + _SECTION)
            end = cut.start() if cut else len(text)
            parts.append(np.array(self._fast.encode_ordinary(text[begin:end]), np.uint32))
            begin = end
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


@functools.cache
def _encoder(vocabulary: str, ranks: str, pattern: str) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(vocabulary, ranks, pattern)


def cuts(tokens: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full windows, then the rest in equal pieces."""
    full, rest = divmod(tokens, capacity)
    out = [(k * capacity, capacity) for k in range(full)]
    n = -(-rest // piece)
    edges = [full * capacity + rest * k // n for k in range(n + 1)] if n else []
    return out + [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def document_pieces(
    docs: DataFrame, tokenizer: tuple[str, str, str], capacity: int = CAPACITY, piece: int = PIECE,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens`` of every piece."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(*tokenizer)
        for batch in batches:
            for part in W.slices(batch, "text"):
                rows, start, length, crc, tokens = [], [], [], [], []
                for row, text in enumerate(part.column("text").to_pylist()):
                    ids = np.append(encoder.encode(text or ""), np.uint32(END_ID)).astype("<u4")
                    for a, n in cuts(len(ids), capacity, piece):
                        rows.append(row)
                        start.append(a)
                        length.append(n)
                        crc.append(zlib.crc32(ids[a : a + n].tobytes()))
                        tokens.append(len(ids))
                numbers = [pa.array(x, pa.int64()) for x in (start, length, crc, tokens)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(rows, pa.int64())), *numbers],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return read.mapInArrow(work, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def difference(sizes: list[int], windows: int) -> list[tuple[int, list[int]]]:
    """Karmarkar-Karp differencing of ``sizes`` into ``windows`` sets: (sum, members), largest first.

    A partial partition lists its non-empty sets, largest first. Two partitions are merged with the
    largest sets of one against the smallest of the other; empty sets are taken first.
    """
    heap = [(-s, k, [(s, [k])]) for k, s in enumerate(sizes)]
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        clash = len(a) + len(b) - windows
        if clash <= 0:
            merged = a + b
        else:
            free = len(a) - clash
            met = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a[free:], reversed(b[len(b) - clash :]), strict=True)]
            merged = a[:free] + met + b[: len(b) - clash]
        merged.sort(key=lambda x: -x[0])
        least = merged[-1][0] if len(merged) == windows else 0
        count += 1
        heapq.heappush(heap, (least - merged[0][0], count, merged))
    return heap[0][2] if heap else []


def balanced(sizes: list[int], capacity: int) -> list[list[int]]:
    """Members of as few near-equal windows as differencing fits into the capacity."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        sets = difference(sizes, windows)
        if not sets or sets[0][0] <= capacity:
            return [members for _, members in sets]
        windows += 1


def pack(pieces: DataFrame, capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table of pieces (column ``length``)."""
    full = pieces.where(F.col("length") == capacity)
    rest = pieces.where(F.col("length") < capacity)
    blocks = max(1, round(rest.count() / block_pieces))
    columns = [*pieces.columns, "sequence_id", "offset"]

    def deal(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "piece_no"]).reset_index(drop=True)
        sizes = rows["length"].tolist()
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        base = int(rows["block"].iloc[0]) << 20
        for w, members in enumerate(balanced(sizes, capacity)):
            at = 0
            for k in members:
                sequence[k], offset[k] = 2 * (base + w) + 1, at
                at += sizes[k]
        rows["sequence_id"], rows["offset"] = sequence, offset
        return rows[columns]

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id bigint, offset bigint"
    dealt = rest.withColumn("block", F.pmod(F.xxhash64("piece_no"), F.lit(blocks)))
    alone = full.withColumn("sequence_id", F.col("piece_no") * 2).withColumn("offset", F.lit(0).cast("long"))
    return alone.unionByName(dealt.groupBy("block").applyInPandas(deal, schema))


def pack_documents(
    docs: DataFrame, tokenizer: tuple[str, str, str], capacity: int = CAPACITY, piece: int = PIECE,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``tokenizer`` names the vocabulary file, the rank file and the pattern of ``Encoder``; both files
    are at these paths on every executor. Every document's ids are followed by the id 1, so a null or empty text is one piece of length 1.
    Null ids are carried, and rows repeated under one id are packed each on their own. Other columns
    are not carried. An empty table gives an empty result.
    """
    pieces = document_pieces(docs, tokenizer, capacity, piece, id_col, text_col)
    numbered = staged(pieces.withColumn("piece_no", F.monotonically_increasing_id()), "pieces")
    return pack(numbered, capacity).drop("piece_no")
