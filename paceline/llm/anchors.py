"""Content-determined anchors: positions that equal passages choose alike."""

from __future__ import annotations

import numpy as np

from paceline.llm import words as W

_rng = np.random.Generator(np.random.PCG64(77))
_CODE = (_rng.integers(1, 1 << 31, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)
_STEP = 0x9E3779B1


def gram_order(raw: np.ndarray, width: int) -> np.ndarray:
    """A number of 32 bits for the ``width`` bytes from each position on (as many as there are full runs).

    It only ranks runs; different runs may have one number. It is never 0.
    """
    have, span, out = _CODE[raw], 1, None
    place, rest, power = 0, width, _STEP
    # The width as a sum of powers of two; each power's numbers come from the one below.
    while rest:
        if rest & 1:
            n = len(raw) - place - span + 1
            if n <= 0:
                return np.zeros(0, np.uint32)
            out = have[place : place + n].copy() if out is None else out[:n] * np.uint32(power) + have[place : place + n]
            place += span
        rest >>= 1
        if rest:
            have = have[: len(have) - span] * np.uint32(power) + have[span:]
            power = power**2 & 0xFFFFFFFF
            span *= 2
    out ^= out >> np.uint32(16)
    out *= np.uint32(0x7FEB352D)
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x846CA68B)
    out ^= out >> np.uint32(16)
    return np.maximum(out, np.uint32(1), out=out)


def gram_hashes(raw: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes from each of the given positions on."""
    out = np.zeros(len(at), np.uint64)
    if not len(at):
        return out
    runs = np.lib.stride_tricks.sliding_window_view(raw, width)[at]
    if width % 8:
        runs = np.concatenate([runs, np.zeros((len(at), -width % 8), np.uint8)], axis=1)
    words = runs.view(np.uint64)
    for k in range(words.shape[1]):
        out = W.mix(out + words[:, k])
    return out


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The least or largest of ``width`` values from each position on."""
    span = 1
    while span * 2 <= width:
        values = best(values[:-span], values[span:])
        span *= 2
    more = width - span
    return best(values[: len(values) - more], values[more:]) if more else values


def anchors(raw: np.ndarray, bounds: np.ndarray, length: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of texts that lie end to end.

    An anchor is a run of ``width`` bytes. Every run of ``length`` bytes inside one text holds the
    anchor of least number among its own runs of ``width`` bytes, all of them on a tie. So two equal
    runs of ``length`` bytes hold equal anchors at equal places. Numbers of 32 bits choose the anchors;
    only the chosen ones, about a tenth of all runs, are hashed to 64 bits.
    """
    inner = length - width + 1
    if len(raw) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    order = gram_order(raw, width)
    least = _sliding(order, inner, np.minimum)
    # Runs that reach into the next text count for nothing.
    beyond = (bounds[1:-1, None] - np.arange(1, length)).ravel()
    least[beyond[(beyond >= 0) & (beyond < len(least))]] = 0
    padded = np.concatenate([np.zeros(inner - 1, np.uint32), least, np.zeros(inner - 1, np.uint32)])
    at = np.flatnonzero((_sliding(padded, inner, np.maximum)[: len(order)] == order) & (order != 0))
    return at, gram_hashes(raw, at, width)
