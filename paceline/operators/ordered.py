"""Running totals, ranks and exact quantiles over unbounded groups.

A window without a bounded partition puts a whole group (or the whole table) into one task. Here
rows are range partitioned on (group, order) instead, so a hot group spans many slabs; each slab is
summed on its own and the slab totals (one row per group and slab) carry the offsets forward.
Quantiles need no order of the rows: counts per cell of a grid tell which few cells hold them.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from paceline.session import staged

_FOLD = {"sum": F.sum, "min": F.min, "max": F.max}
_JOIN = {
    "sum": lambda before, here: F.coalesce(before, F.lit(0)) + here,
    "min": lambda before, here: F.least(before, here),
    "max": lambda before, here: F.greatest(before, here),
}


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    folds: dict[str, tuple[str, Column]],
) -> DataFrame:
    """Add inclusive running folds over ``order`` within ``by``.

    ``folds`` maps an output name to (``sum`` | ``min`` | ``max``, input column). For each output a
    column ``<name>_all`` with the fold over the whole group is added as well. ``order`` has to be
    total within a group, and ``by`` columns may not be NULL.
    """
    by = list(by)
    slabs = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wide = df
    for name, (_, col) in folds.items():
        wide = wide.withColumn(f"_in_{name}", col)
    rows = staged(
        wide.repartitionByRange(slabs, *[F.col(c) for c in by], *order).withColumn("_slab", F.spark_partition_id()),
        "running",
    )
    part = rows.groupBy(*by, "_slab").agg(*[_FOLD[k](f"_in_{n}").alias(f"_part_{n}") for n, (k, _) in folds.items()])
    # Without ``by`` this window is over one row per slab.
    group = Window.partitionBy(*by)
    before = group.orderBy("_slab").rowsBetween(Window.unboundedPreceding, -1)
    offsets = part.select(
        *by,
        "_slab",
        *[_FOLD[k](f"_part_{n}").over(before).alias(f"_before_{n}") for n, (k, _) in folds.items()],
        *[_FOLD[k](f"_part_{n}").over(group).alias(f"{n}_all") for n, (k, _) in folds.items()],
    )
    inside = (
        Window.partitionBy(*by, "_slab").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = rows
    for name, (kind, _) in folds.items():
        out = out.withColumn(f"_here_{name}", _FOLD[kind](f"_in_{name}").over(inside))
    out = out.join(offsets, [*by, "_slab"], "left")
    for name, (kind, _) in folds.items():
        out = out.withColumn(name, _JOIN[kind](F.col(f"_before_{name}"), F.col(f"_here_{name}")))
    helper = ["_slab"] + [f"{p}{n}" for n in folds for p in ("_in_", "_here_", "_before_")]
    return out.drop(*helper)


def positions(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "pos") -> DataFrame:
    """1-based row position within ``by`` plus the group size (``<name>_all``)."""
    return running(df, by, order, {name: ("sum", F.lit(1).cast("long"))})


# The grid of the first pass: 64 cells per doubling of the size, infinities and NaN in cells of their own.
_CELLS_PER_OCTAVE, _SMALLEST_EXPONENT, _LAST_CELL = 64, 1075, 1 << 20
# Cells of a later pass, and the rows of a cell that one task may order.
_SPLIT, _ORDERED_ROWS = 1024, 10_000
# Tables of at most so many rows are counted by value at once; the result is the same.
_FEW_ROWS = 1_000_000


def _grid_cell(value: Column) -> Column:
    """Number of the cell that holds ``value``; it never falls while the value rises."""
    x = value.cast("double")
    size = F.when(F.abs(x) == F.lit(float("inf")), F.lit(_LAST_CELL)).otherwise(
        F.floor((F.log2(F.abs(x)) + _SMALLEST_EXPONENT) * _CELLS_PER_OCTAVE) + 1)
    return F.when(F.isnan(x), F.lit(_LAST_CELL + 1)).when(x == 0, F.lit(0)).otherwise(F.signum(x).cast("int") * size).cast("long")


def _part_of(value: Column, low: Column, high: Column) -> Column:
    """One of ``_SPLIT`` + 1 equal parts of [low, high]; the ends fall into different parts."""
    # Both ends are of one grid cell, so the differences neither overflow nor vanish.
    return F.floor((value - low).cast("double") / (high - low).cast("double") * _SPLIT)


def _counted(rows: DataFrame, group: Sequence[str], cell: str, start: Column) -> DataFrame:
    """Rows, least and largest value per cell, with the rows that lie before the cell."""
    cells = rows.groupBy(*group, cell).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    # A group has a bounded number of cells, whatever its rows.
    before = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    return cells.withColumn("_base", start + F.coalesce(F.sum("_n").over(before), F.lit(0)))


def _holds(rank: Column) -> Column:
    return (F.col("_base") <= rank) & (rank < F.col("_base") + F.col("_n"))


def _ends(p: float) -> tuple[Column, Column, Column]:
    at = F.lit(float(p)) * (F.col("_all") - 1)
    return at, F.floor(at), F.ceil(at)


def distributions(
    df: DataFrame,
    by: Sequence[str],
    values: dict[str, Column],
    quantiles: dict[str, tuple[str, float]],
    stats: Sequence[Column] = (),
) -> DataFrame:
    """Exact, linearly interpolated quantiles of several values per group, without sorting the rows.

    ``quantiles`` maps an output to (name of a value, share). NULLs of a value do not count for it; a
    group whose values are all NULL is left out, and without ``by`` an empty input gives one row of
    NULLs. ``by`` columns may not be NULL. ``stats`` are further aggregates over the rows (columns:
    the names of ``values``, and ``c``, which is 1).

    The rows, cut to these columns, are written once. A first pass counts them per cell of a fixed
    grid, combined on the map side, so that only counts are shuffled; only cells that hold a wanted
    rank are read again, and split, until they hold one value or few rows. All outputs share the
    passes. The result, a row per group, is written too, so that its size is known to later joins.
    Up to ``_FEW_ROWS`` rows each value is a cell of its own, and no further pass is needed.
    """
    by, names = list(by), list(values)
    narrow = df.select(*by, *[c.alias(n) for n, c in values.items()], F.lit(1).cast("long").alias("c"))
    some = functools.reduce(operator.or_, [F.col(n).isNotNull() for n in names])
    rows = staged(narrow.where(some), "values")
    wanted = {n: [p for v, p in quantiles.values() if v == n] for n in names}
    entries = [F.struct(F.lit(i).alias("_of"), F.col(n).alias("_v")) for i, n in enumerate(names) if wanted[n]]
    group = [*by, "_of"]
    long = rows.select(*by, F.inline(F.array(*entries))).where(F.col("_v").isNotNull())
    few = rows.count() <= _FEW_ROWS
    long = long.withColumn("_cell", F.col("_v") if few else _grid_cell(F.col("_v")))

    cells = _counted(long, group, "_cell", F.lit(0)).withColumn("_all", F.sum("_n").over(Window.partitionBy(*group)))
    ranks = F.array()
    for i, n in enumerate(names):
        if wanted[n]:
            ranks = F.when(F.col("_of") == i, F.array(*[end for p in wanted[n] for end in _ends(p)[1:]])).otherwise(ranks)
    hit = F.explode(F.filter(F.array_distinct(ranks), _holds))
    fields = [*group, "_cell", "_all", "_rank", "_base", "_n", "_lo", "_hi"]
    found = cells.withColumn("_rank", hit).select(*fields)

    def gathered(exact: DataFrame) -> DataFrame:
        def quantile(of: int, p: float) -> Column:
            at, low, high = _ends(p)
            value_at = lambda k: F.max(F.when((F.col("_of") == of) & (F.col("_rank") == k), F.col("_v")))
            return value_at(low) + (value_at(high) - value_at(low)) * F.max(F.when(F.col("_of") == of, at - low))

        out = exact.groupBy(*by).agg(*[quantile(names.index(v), p).alias(n) for n, (v, p) in quantiles.items()])
        if by and stats:
            return rows.groupBy(*by).agg(*stats).join(out, by, "left")
        if stats:
            return rows.agg(*stats).withColumn("_q", out.select(F.struct(*quantiles).alias("_q")).scalar()).select("*", "_q.*").drop("_q")
        return out

    if few:
        return gathered(found.withColumn("_v", F.col("_lo")))
    found = staged(found, "ranks")
    wide = F.col("_lo") < F.col("_hi")
    large = wide & (F.col("_n") > _ORDERED_ROWS)
    span = [*group, "_cell", "_from"]

    def inside(targets: DataFrame) -> DataFrame:
        spans = targets.select(*group, "_cell", F.col("_lo").alias("_from"), F.col("_hi").alias("_to"), F.col("_base").alias("_start")).distinct()
        return long.join(spans, [*group, "_cell"]).where(F.col("_v").between(F.col("_from"), F.col("_to")))

    while found.where(large).limit(1).collect():
        parts = inside(found.where(large)).withColumn("_part", _part_of(F.col("_v"), F.col("_from"), F.col("_to")))
        finer = _counted(parts, [*span, "_start"], "_part", F.col("_start"))
        asked = found.where(large).select(*group, "_cell", F.col("_lo").alias("_from"), "_all", "_rank")
        found = staged(
            found.where(~large).unionByName(asked.join(finer, span).where(_holds(F.col("_rank"))).select(*fields)), "ranks")

    counts = inside(found.where(wide)).groupBy(*span, "_start", "_v").agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(*span).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ordered = counts.withColumn("_base", F.col("_start") + F.coalesce(F.sum("_n").over(order), F.lit(0)))
    asked = found.where(wide).select(*group, "_cell", F.col("_lo").alias("_from"), "_all", "_rank")
    exact = asked.join(ordered, span).where(_holds(F.col("_rank"))).select(*group, "_all", "_rank", "_v").unionByName(
        found.where(~wide).select(*group, "_all", "_rank", F.col("_lo").alias("_v")))
    return staged(gathered(exact), "quantiles")


def distribution(
    df: DataFrame,
    by: Sequence[str],
    value: Column,
    quantiles: dict[str, float],
    stats: Sequence[Column] = (),
) -> DataFrame:
    """``distributions`` of one value; ``stats`` name it ``v``."""
    return distributions(df, by, {"v": value}, {n: ("v", p) for n, p in quantiles.items()}, stats)


# Aggregates over the rows of a distribution, for use as ``stats``.
def n_values() -> Column:
    return F.sum("c")


def mean_value() -> Column:
    return F.sum(F.col("v") * F.col("c")) / F.sum("c")


def share(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("c")).otherwise(0)) / F.sum("c")
