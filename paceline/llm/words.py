"""Words and word shingles of whole texts as 64-bit hashes, computed on Arrow buffers.

Texts stay UTF-8 bytes. A byte table maps each byte to 0 (separator) or to the byte that is hashed,
so splitting and case folding cost one lookup. Long texts are worked through in pieces that end at
a separator; memory follows the piece, not the text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes worked on at once; about forty times as much memory is used for that long.
PIECE = 1 << 19
#: Text bytes of one slice of an Arrow batch.
SLICE = 2 << 20
_PLACES = 1024
# Where the C library has it.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 1 << 63, _PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FAR = _rng.integers(1, 1 << 63, _PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _folded() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def blank_separated() -> np.ndarray:
    """Words are runs of anything but space, tab, LF, VT, FF and CR; A-Z are lower-cased."""
    table = _folded()
    table[[0x20, *range(0x09, 0x0E)]] = 0
    return table


def alphanumeric() -> np.ndarray:
    """Words are runs of ASCII letters and digits and of all non-ASCII bytes; A-Z are lower-cased."""
    table = _folded()
    keep = np.zeros(256, bool)
    keep[48:58] = keep[97:123] = keep[65:91] = True
    keep[128:] = True
    table[~keep] = 0
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Sequences(NamedTuple):
    """Values of several texts end to end; text i has ``values[bounds[i]:bounds[i + 1]]``."""

    values: np.ndarray
    bounds: np.ndarray

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array end to end and the bounds of each text; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Row ranges of ``batch`` with about ``most`` bytes of text, or one longer text, each."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, total, begin = np.cumsum(sizes), 0, 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(ends, total + most, "right")))
        yield batch.slice(begin, end - begin)
        begin, total = end, int(ends[end - 1])
    release()


def release() -> None:
    """Hand freed memory back to the system; a Python worker is kept and used again for many tasks."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def _piece_words(raw: np.ndarray, fresh: np.ndarray, prefixes: tuple[int, ...]) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of words and of their prefixes, and the words' starts, in folded bytes.

    ``fresh`` lists positions where a text begins.
    """
    word = raw != 0
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    before[fresh] = False
    starts = np.flatnonzero(word & ~before)
    if not len(starts):
        return [np.zeros(0, np.uint64)] * (1 + len(prefixes)), starts
    spans = np.diff(np.append(starts, len(raw)))
    # Position within the word; separators after a word go on counting and are masked.
    place = np.arange(starts[0], len(raw), dtype=np.int32) - np.repeat(starts.astype(np.int32), spans)
    body, there = raw[starts[0] :], word[starts[0] :]
    longest = int(spans.max())
    if longest <= _PLACES:
        values = _PLACE[place]
    else:
        values = _PLACE[place % _PLACES] * _FAR[place // _PLACES % _PLACES]
    values *= _BYTE[body]
    values[~there] = 0
    at = starts - starts[0]
    whole = [mix(np.add.reduceat(values, at))]
    for k in prefixes:
        values[place >= k] = 0
        whole.append(mix(np.add.reduceat(values, at) ^ np.uint64(k)))
    return whole, starts


def word_hashes(texts: pa.Array, table: np.ndarray) -> Sequences:
    """A hash for each word of each text."""
    (hashes,), _, bounds = located_words(texts, table)
    return Sequences(hashes, bounds)


def located_words(
    texts: pa.Array, table: np.ndarray, prefixes: tuple[int, ...] = ()
) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes of all words, then those of their first k bytes for falling k in ``prefixes``.

    Also the words' starts in the bytes of ``text_buffer``, and each text's bounds in these arrays.
    """
    raw, bounds = text_buffer(texts)
    found, at, begin = [], [], 0
    while begin < len(raw):
        end = min(begin + PIECE, len(raw))
        if end < len(raw):
            # End behind a separator or where a text ends; a longer word widens the piece.
            while True:
                gaps = np.flatnonzero(table[raw[begin:end]] == 0)
                edge = int(bounds[np.searchsorted(bounds, end, "right") - 1])
                cut = max(begin + int(gaps[-1]) + 1 if len(gaps) else begin, edge)
                if cut > begin or end == len(raw):
                    end = cut if cut > begin else end
                    break
                end = min(end + PIECE, len(raw))
        first, last = np.searchsorted(bounds, [begin, end])
        hashes, starts = _piece_words(table[raw[begin:end]], np.unique(bounds[first:last]) - begin, prefixes)
        found.append(hashes)
        at.append(starts + begin)
        begin = end
    if not found:
        found, at = [[np.zeros(0, np.uint64)] * (1 + len(prefixes))], [np.zeros(0, np.int64)]
    starts = np.concatenate(at)
    return [np.concatenate(x) for x in zip(*found, strict=True)], starts, np.searchsorted(starts, bounds)


def shingles(words: Sequences, width: int) -> Sequences:
    """Hashes of the runs of ``width`` words; a shorter text gives its whole sequence, an empty one none."""
    values, bounds = words
    counts = np.diff(bounds)
    short = (counts > 0) & (counts < width)
    n = len(values) - width + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(width if n > 0 else 0):
        rolled += values[k : k + n] * _STEP[k]
    out_counts = np.where(short, 1, np.maximum(counts - width + 1, 0))
    out_bounds = np.concatenate([[0], np.cumsum(out_counts)])
    take = np.repeat(bounds[:-1], out_counts) + np.arange(out_bounds[-1]) - np.repeat(out_bounds[:-1], out_counts)
    whole = np.flatnonzero(short)
    if len(whole):
        out = np.zeros(len(take), np.uint64)
        full = np.ones(len(take), bool)
        full[out_bounds[whole]] = False
        out[full] = mix(rolled[take[full]])
        for i in whole:
            part = values[bounds[i] : bounds[i + 1]]
            out[out_bounds[i]] = (part * _STEP[: len(part)]).sum() + np.uint64(len(part))
        out[out_bounds[whole]] = mix(out[out_bounds[whole]])
        return Sequences(out, out_bounds)
    return Sequences(mix(rolled[take]), out_bounds)


def distinct(seq: Sequences) -> Sequences:
    """Each text's values sorted and without repeats."""
    values, bounds = seq
    if not len(values):
        return seq
    parts = [np.unique(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return Sequences(np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])]))
