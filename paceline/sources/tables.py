"""Scans, appends, monthly partitions and keyed ledgers (2.1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from paceline.functions.moments import month_of
from paceline.keys import RACE
from paceline.operators.dedup import dedup_latest, first_per_key
from paceline.schemas import schema_for
from paceline.sources import batches as vb

MONTH = "race_month"
#: The partition of rows without a valid date.
BAD = "bad"
#: Months of the years 1 to 9999: with so many bins the counts of ``histogram_numeric`` are never merged.
MONTHS = 12 * 9999


def scan_table(spark: SparkSession, root: str, name: str, fmt: str = "csv") -> DataFrame:
    options = {"header": "true"} if fmt == "csv" else {}
    return vb.read_or_empty(spark, f"{root}/{name}", fmt, schema_for(name), **options)


def scan_headerless(spark: SparkSession, path: str, name: str) -> DataFrame:
    """CSV files that start with data: the names come from the schema."""
    return vb.read_or_empty(spark, path, "csv", schema_for(name), header="false")


def conform(df: DataFrame, name: str) -> DataFrame:
    """Schema columns in order: extra ones are left out, missing ones are NULL."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema_for(name)
    ])


def append_rows(df: DataFrame, root: str, name: str, fmt: str = "csv") -> None:
    writer = conform(df, name).write.mode("append").format(fmt)
    (writer.option("header", "true") if fmt == "csv" else writer).save(f"{root}/{name}")


def append_snapshots(df: DataFrame, store: str, batch: str) -> None:
    """Add price snapshots to the monthly store under their own batch.

    A batch is replaced as a whole and in one step (see ``batches``): a repeated load changes nothing, a
    corrected one leaves no rows of months it no longer has, a load that dies leaves the old rows, and a
    late file is one more batch.
    """
    rows = conform(df, "race_odds_prerace").withColumn(MONTH, month_of(F.col("race_date")))
    version = write_months(rows, store)
    vb.commit_batch(month_counts(df.sparkSession, store, version), store, batch, version)


def write_months(rows: DataFrame, store: str) -> str:
    """Write rows aside by month. Rebalancing keeps the files of a month few; one above the advisory size is split."""
    return vb.write_version(rows.hint("rebalance", F.col(MONTH)), store, [MONTH])


def stored_schema():
    return schema_for("race_odds_prerace").add(MONTH, "string").add(vb.VERSION, "string")


def month_counts(spark: SparkSession, store: str, version: str) -> DataFrame:
    """Rows per month that a version holds; no column is read, so the files' footers answer."""
    rows = vb.read_versions(spark, store, [version], stored_schema())
    return rows.groupBy(F.col(MONTH).alias("month")).agg(F.count(F.lit(1)).alias("n_rows"))


def scan_partitions(
    spark: SparkSession, store: str, start: str | None = None, end: str | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows of a closed date range; the month filter prunes partitions, the date filter goes to the scan.

    Of every batch its valid version is read, if it holds a month of the range. Rows that a migration could
    not date are not part of the store.
    """
    versions = vb.valid_versions(spark, store, start=start and start[:7], end=end and end[:7])
    df = vb.read_versions(spark, store, versions, stored_schema())
    if start:
        df = df.where((F.col(MONTH) >= start[:7]) & (F.col("race_date") >= F.lit(start).cast("date")))
    if end:
        df = df.where((F.col(MONTH) <= end[:7]) & (F.col("race_date") <= F.lit(end).cast("date")))
    df = df.where(~F.col(MONTH).eqNullSafe(BAD))
    return df.select(*columns) if columns else df.drop(MONTH, vb.VERSION)


def month_sources(spark: SparkSession, store: str) -> DataFrame:
    """(``month``, ``versions``, ``source``): the valid versions that hold rows of a month, and their digest."""
    held = vb.valid(spark, store).where((F.col("n_rows") > 0) & (F.col("month") != BAD))
    listed = held.groupBy("month").agg(F.sort_array(F.collect_set(vb.VERSION)).alias("versions"))
    return listed.withColumn("source", F.sha2(F.array_join("versions", ","), 256))


def close_months(spark: SparkSession, store: str, latest: str, before: str, ties: Sequence[str]) -> list[str]:
    """Keep the newest price per combination of every month before ``before`` (``2026-09``) in a table of its own.

    A month's rows are valid for the versions they were made from: only months that gained, lost or changed
    a version since are computed again, and all of them become valid in one step. Returns the computed months.
    """
    made = vb.valid(spark, latest).select("month", "source")
    stale = month_sources(spark, store).where(F.col("month") < before).join(made, ["month", "source"], "left_anti").collect()
    if not stale:
        return []
    # Versions never change, so the rows are those of the digest even if a load commits meanwhile.
    rows = vb.read_versions(spark, store, list({v for r in stale for v in r.versions}), stored_schema())
    rows = rows.where(F.concat(F.col(MONTH), F.lit("/"), F.col(vb.VERSION)).isin([f"{r.month}/{v}" for r in stale for v in r.versions]))
    version = write_months(dedup_latest(rows.drop(MONTH, vb.VERSION), ties).withColumn(MONTH, month_of(F.col("race_date"))), latest)
    closed = spark.createDataFrame([(r.month, r.source) for r in stale], "month string, source string")
    counted = closed.join(month_counts(spark, latest, version), "month", "left").fillna(0, ["n_rows"])
    vb.commit(counted.withColumn("batch", F.col("month")), latest, version)
    return sorted(r.month for r in stale)


def scan_latest(
    spark: SparkSession, store: str, latest: str, ties: Sequence[str], start: str | None = None, end: str | None = None
) -> DataFrame:
    """Newest price per combination: closed months from their own table, all others reduced here.

    A closed month that the store has changed since is reduced here too, so the rows are always those of
    ``dedup_latest`` over ``scan_partitions``. The key holds the race's date, so no key lies in both parts.
    """
    now = month_sources(spark, store).select("month", "source")
    fresh = vb.valid(spark, latest).select("month", "source", vb.VERSION).join(now, ["month", "source"], "left_semi").collect()
    versions = vb.valid_versions(spark, store, start=start and start[:7], end=end and end[:7])
    names = schema_for("race_odds_prerace").names
    raw = vb.read_versions(spark, store, versions, stored_schema()).where(~F.col(MONTH).eqNullSafe(BAD))
    raw = raw.where(~F.coalesce(F.col(MONTH).isin([r.month for r in fresh]), F.lit(False)))
    kept = vb.read_versions(spark, latest, list({r.version for r in fresh}), stored_schema())
    kept = kept.where(F.concat(F.col(MONTH), F.lit("/"), F.col(vb.VERSION)).isin([f"{r.month}/{r.version}" for r in fresh]))
    if start:
        raw, kept = (d.where((F.col(MONTH) >= start[:7]) & (F.col("race_date") >= F.lit(start).cast("date"))) for d in (raw, kept))
    if end:
        raw, kept = (d.where((F.col(MONTH) <= end[:7]) & (F.col("race_date") <= F.lit(end).cast("date"))) for d in (raw, kept))
    return kept.select(*names).unionByName(dedup_latest(raw.select(*names), ties))


def scan_with_legacy(store: DataFrame, legacy: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Monthly store plus the old single table, aligned by column name."""
    from paceline.operators.cleaning import date_range

    return store.unionByName(date_range(legacy, start, end), allowMissingColumns=True)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def existing_keys(keys: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """Mark which keys are already loaded."""
    have = table.select(*on).distinct().withColumn("_have", F.lit(True))
    return keys.join(have, list(on), "left").withColumn("loaded", F.coalesce("_have", F.lit(False))).drop("_have")


def key_sizes(tables: dict[str, DataFrame], on: Sequence[str]) -> DataFrame:
    """Distinct keys per table."""
    parts = [t.agg(F.countDistinct(*on).alias("n_keys")).select(F.lit(n).alias("table_name"), "n_keys") for n, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def partition_migrate(legacy: DataFrame, store: str, quarantine: str, batch: str) -> DataFrame:
    """Split a single table into the monthly store; rows without a valid date go to quarantine, whole.

    The table is read once: rows of both kinds are written in one pass, those without a date of the years
    1 to 9999 as a partition ``bad`` that holds their own columns, and the pass counts what it is given per
    month. It counts behind the exchange, where a task that runs again is counted once. The quarantine is
    copied from that partition and committed before the store; a load that dies leaves the store as it was.

    Returns rows given to the writer and rows found in the files per month (``bad`` for the quarantine);
    they have to agree. The counts are taken by the call, not by the result.
    """
    spark = legacy.sparkSession
    day = F.col("race_date").cast("string").try_cast("date")
    dated = legacy.withColumn("_day", F.when(F.year(day).between(1, 9999), day))
    good, have = F.col("_day").isNotNull(), set(legacy.columns)
    columns = [F.when(good, F.col("_day") if f.name == "race_date" else F.col(f.name)).cast(f.dataType).alias(f.name)
               if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema_for("race_odds_prerace")]
    month = F.coalesce(month_of(F.col("_day")), F.lit(BAD)).alias(MONTH)
    rows = dated.select(*columns, F.when(~good, F.struct(*legacy.columns)).alias("rejected"), month)
    seen = Observation()
    number = F.year("race_date") * 12 + F.month("race_date") - 1
    counted = rows.hint("rebalance", F.col(MONTH)).observe(
        seen, F.histogram_numeric(number, F.lit(MONTHS)).alias("months"), F.count_if(F.col(MONTH) == BAD).alias("bad"))
    version = vb.write_version(counted, store, [MONTH])
    given = [(f"{int(r.x) // 12:04d}-{int(r.x) % 12 + 1:02d}", int(r.y)) for r in seen.get["months"] or []]
    given += [(BAD, seen.get["bad"])] if seen.get["bad"] else []

    schema = stored_schema().add("rejected", legacy.schema)
    bad = vb.read_versions(spark, store, [version], schema).where(F.col(MONTH) == BAD).select("rejected.*")
    side = vb.write_version(bad, quarantine)
    # ``add`` changes the frame's own schema, so the version is put behind a copy.
    held = vb.read_versions(spark, quarantine, [side], StructType(list(legacy.schema.fields)).add(vb.VERSION, "string"))
    kept = held.groupBy(F.lit(BAD).alias("month")).agg(F.count(F.lit(1)).alias("n_rows"))
    vb.commit_batch(kept, quarantine, batch, side)
    vb.commit_batch(month_counts(spark, store, version), store, batch, version)

    found = vb.commits(spark, store).where((F.col(vb.VERSION) == version) & (F.col("n_rows") > 0) & (F.col("month") != BAD))
    found = found.unionByName(vb.commits(spark, quarantine).where((F.col(vb.VERSION) == side) & (F.col("n_rows") > 0)))
    before = spark.createDataFrame(given, "month string, n_in long")
    out = before.join(found.select("month", F.col("n_rows").alias("n_out")), "month", "full").fillna(0, ["n_in", "n_out"])
    return out.withColumn("agrees", F.col("n_in") == F.col("n_out"))


def scan_quarantine(spark: SparkSession, quarantine: str, schema) -> DataFrame:
    """Rows that migrations could not date, as they came."""
    rows = vb.read_versions(spark, quarantine, vb.valid_versions(spark, quarantine), schema)
    return rows.select(*schema.names)


def salvage_rows(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Lines of a damaged headerless file that start with a date, parsed with the table's schema."""
    lines = spark.read.text(path).where(F.col("value").rlike(r"^\d{4}-\d{2}-\d{2},"))
    return lines.select(F.from_csv("value", schema_for(name).simpleString()[7:-1].replace(":", " ").replace(",", ", ")).alias("r")).select("r.*")


def merge_replace(old: DataFrame, new: DataFrame, regen_start: str, date: str = "race_date") -> DataFrame:
    """Rows before ``regen_start`` from the old table, all others from the new one; old column order."""
    kept = old.where(F.col(date) < F.lit(regen_start).cast("date"))
    return kept.unionByName(new, allowMissingColumns=True).select(*old.columns)


def refresh_window(old: DataFrame, fresh: DataFrame, today: str, days: int | None) -> DataFrame:
    """Recompute the last ``days`` days of a ledger and keep the rest; None recomputes everything."""
    if days is None:
        return fresh
    start = F.date_sub(F.lit(today).cast("date"), days)
    return old.where(F.col("race_date") < start).unionByName(fresh.where(F.col("race_date") >= start))


def fill_missing(scores: DataFrame, existing: DataFrame, train_end: str, regen_start: str) -> DataFrame:
    """Add scores of races absent from the output, between the training end and the regenerated part."""
    day = F.col("race_date")
    gap = (day > F.lit(train_end).cast("date")) & (day < F.lit(regen_start).cast("date"))
    fresh = scores.where(gap).join(existing.select(*RACE).distinct(), RACE, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def append_history(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append by name; columns that either side lacks are NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def keyed_insert(ledger: DataFrame, rows: DataFrame, keys: Sequence[str], reasons: Sequence[str]) -> DataFrame:
    """Add rows whose key is new and whose reason is allowed; a NULL key part equals a NULL.

    Of several allowed reasons for a key the one named first in ``reasons`` is kept.
    """
    rank = F.array_position(F.array(*[F.lit(r) for r in reasons]), F.col("reason"))
    allowed = first_per_key(rows.where(F.col("reason").isin(*reasons)), list(keys), [rank])
    a, z = allowed.alias("a"), ledger.select(*keys).distinct().alias("z")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"z.{k}"))
    return ledger.unionByName(a.join(z, same, "left_anti").select(*ledger.columns))


