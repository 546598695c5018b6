"""Clipped logits, ratios and bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def settle(x: Column, digits: int = 9) -> Column:
    """Round half away from zero on the scaled double, so that sums in another order agree."""
    scale = float(10**digits)
    return F.round(x * scale) / scale


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def logit(p: Column, eps: float = 1e-4) -> Column:
    q = clip(p, eps, 1 - eps)
    return F.ln(q / (1 - q))


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def front_run_ratio(n: Column, m: Column, s: Column) -> Column:
    zero = F.lit(0)
    n, m, s = F.coalesce(n, zero), F.coalesce(m, zero), F.coalesce(s, zero)
    return n / (n + m + s + 1)


def position_ratio(pos: Column, size: Column) -> Column:
    return F.coalesce(F.try_divide(pos - 1, size - 1), F.lit(0.0))


def band(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Left-closed bands ``[e0,e1) [e1,e2) …``; values outside the edges get NULL."""
    out = F.lit(None).cast("string")
    for low, high, label in reversed(list(zip(edges[:-1], edges[1:], labels, strict=True))):
        out = F.when((x >= low) & (x < high), label).otherwise(out)
    return out


def start_band(st_time: Column) -> Column:
    """Part of the day from the first start time; unparsable text counts as day."""
    hour = F.substring(st_time, 1, 2).try_cast("int")
    return (
        F.when(hour < 10, "morning").when(hour < 15, "day").when(hour < 20, "night")
        .when(hour >= 20, "midnight").otherwise("day")
    )


def delay_bin(minutes: Column) -> Column:
    return (
        F.when(minutes < -10, "<-10").when(minutes < 0, "-10..-1").when(minutes == 0, "0")
        .when(minutes <= 5, "1..5").otherwise(">5")
    )


def offset_label(offset: Column) -> Column:
    """Capture offset as text: 5.0 gives ``5``, 0.5 stays ``0.5``."""
    return F.when(offset == F.floor(offset), offset.cast("int").cast("string")).otherwise(offset.cast("string"))
