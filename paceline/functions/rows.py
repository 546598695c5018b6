"""Several result rows from one input row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def inline_rows(names: Sequence[str], *rows: Sequence[Column | str | int | float | None]) -> Column:
    """``inline`` of literal rows; plain values become literals."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.inline(F.array(*[F.struct(*[as_col(v).alias(n) for n, v in zip(names, r, strict=True)]) for r in rows]))
