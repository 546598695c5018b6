"""Versioned batches: data is written aside and becomes valid by one row of a commit table.

A root holds ``data/version=<id>/...`` and ``commits``. A load writes a new version first; nothing reads
it until its commit, a single Parquet file, is there. The newest commit of a batch names its valid
version, so a load that dies leaves the batch as it was, and a reader sees the old batch or the new one,
never a part. Versions that lost their place stay until retention removes them (``superseded``).

Only the commit table, one row per load and month, is read by the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

VERSION = "version"
#: One row per load and month that it holds, and one with a NULL month, so that an empty load counts too.
COMMIT_SCHEMA = "batch string, version string, seq long, month string, n_rows long, source string"


def read_or_empty(spark: SparkSession, paths: str | Sequence[str], fmt: str, schema, **options) -> DataFrame:
    """Read with a fixed schema; a path that is not there is an empty table."""
    try:
        return spark.read.schema(schema).options(**options).format(fmt).load(paths)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def commits(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root}/commits", "parquet", COMMIT_SCHEMA)


def valid(spark: SparkSession, root: str) -> DataFrame:
    """The commit rows of the valid version of every batch."""
    newest = F.max(F.struct("seq", VERSION)).over(Window.partitionBy("batch"))
    return commits(spark, root).withColumn("_top", newest).where(F.col(VERSION) == F.col("_top.version")).drop("_top")


def superseded(spark: SparkSession, root: str) -> DataFrame:
    """Folders whose version lost its place to a newer commit: what retention may remove."""
    old = commits(spark, root).select(VERSION).distinct().join(valid(spark, root).select(VERSION).distinct(), VERSION, "left_anti")
    return old.select(F.concat(F.lit(f"{root}/data/version="), F.col(VERSION)).alias("folder"))


def write_version(rows: DataFrame, root: str, partition_by: Sequence[str] = ()) -> str:
    """Write rows aside under a new version, which nothing reads before its commit."""
    version = uuid.uuid4().hex
    writer = rows.write.partitionBy(*partition_by) if partition_by else rows.write
    writer.parquet(f"{root}/data/version={version}")
    return version


def commit(entries: DataFrame, root: str, version: str) -> None:
    """Make a version valid for its batches in one step.

    ``entries`` holds ``batch``, ``month``, ``n_rows`` and ``source``. They go into one file, which is there
    whole or not at all.
    """
    spark = entries.sparkSession
    last = commits(spark, root).agg(F.max("seq")).first()[0] or 0
    rows = entries.select("batch", F.lit(version).alias(VERSION), F.lit(last + 1).cast("long").alias("seq"), "month", "n_rows", "source")
    rows.coalesce(1).write.mode("append").parquet(f"{root}/commits")


def commit_batch(counts: DataFrame, root: str, batch: str, version: str) -> None:
    """Commit one batch with its rows per ``month``."""
    spark = counts.sparkSession
    none = F.lit(None).cast("string")
    mark = spark.range(1).select(none.alias("month"), F.lit(0).cast("long").alias("n_rows"))
    commit(counts.select("month", "n_rows").unionByName(mark).select(F.lit(batch).alias("batch"), "month", "n_rows", none.alias("source")), root, version)


def read_versions(spark: SparkSession, root: str, versions: Sequence[str], schema: StructType) -> DataFrame:
    """The rows of some versions; the version is a partition column."""
    if not versions:
        return spark.createDataFrame([], schema)
    data = f"{root}/data"
    return read_or_empty(spark, [f"{data}/version={v}" for v in sorted(versions)], "parquet", schema, basePath=data)


def valid_versions(spark: SparkSession, root: str, batch: str | None = None, start: str | None = None, end: str | None = None) -> list[str]:
    """Versions to read, of one batch or of all; only those with rows in a closed range of months."""
    rows = valid(spark, root)
    if batch is not None:
        rows = rows.where(F.col("batch") == batch)
    if start or end:
        rows = rows.where(F.col("month").between(start or "", end or "~"))
    return [r[0] for r in rows.where(F.col("n_rows") > 0).select(VERSION).distinct().collect()]
