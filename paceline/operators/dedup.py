"""Keep one row per key.

All of these are aggregations with a map-side combine: a key that is repeated in a third of the
table is reduced before the shuffle, where a ``row_number`` window would move every copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paceline.keys import CAR, COMBO


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], keep: Sequence[str] | None, fold) -> DataFrame:
    """Columns named in ``order`` are carried once; only computed ones go beside the row."""
    keep = [c for c in (keep or df.columns) if c not in keys]
    named = [o for o in dict.fromkeys(order) if isinstance(o, str)] if all(isinstance(o, str) for o in order) else []
    ranked = named or [o.alias(f"_o{i}") for i, o in enumerate(order)]
    rest = [c for c in keep if c not in named]
    best = fold(F.struct(F.struct(*ranked).alias("o"), *([F.struct(*rest).alias("r")] if rest else []))).alias("_best")
    at = lambda c: F.col(f"_best.{'o' if c in named else 'r'}.{c}").alias(c)
    return df.groupBy(*keys).agg(best).select(*keys, *[at(c) for c in keep])


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], keep: Sequence[str] | None = None) -> DataFrame:
    """The row with the largest ``order`` per key; the row itself breaks remaining ties."""
    return _pick(df, keys, order, keep, F.max)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], keep: Sequence[str] | None = None) -> DataFrame:
    return _pick(df, keys, order, keep, F.min)


def dedup_latest(odds: DataFrame, ties: Sequence[str], keys: Sequence[str] = COMBO) -> DataFrame:
    """Newest snapshot with a price above zero per combination."""
    live = odds.where(F.col("odds").try_cast("double") > 0)
    return newest_per_key(live, keys, ["snapshot_dt", *ties])


def dedup_latest_by_offset(odds: DataFrame, ties: Sequence[str]) -> DataFrame:
    return dedup_latest(odds, ties, [*COMBO, "target_offset_min"])


def dup_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first per key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"), F.sum(F.col("n") - 1).alias("n_surplus")
    )


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Row counts before and after removing rows equal in all columns."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return per_row.agg(
        F.sum("n").alias("n_before"), F.count(F.lit(1)).alias("n_after"), F.sum(F.col("n") - 1).alias("n_removed")
    )


def select_official(runs: DataFrame, ties: Sequence[str]) -> DataFrame:
    """Official predictions only, the newest per car."""
    official = runs.where(F.col("run_type") == "official")
    return newest_per_key(official, CAR, ["predicted_at", *ties])
