"""Session set-up and the shared scratch area for cut lineage."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "paceline", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="paceline-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of its own machine; on a cluster the
    executors would not see it, so an unset folder is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_scratch()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/paceline/{label}-{uuid.uuid4().hex}"


def bucket_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucketed(df: DataFrame, label: str, key: str) -> str:
    """Write ``df`` once to the shared folder in buckets by ``key`` and return the table's name.

    There are as many buckets as shuffle partitions, one file each. Tables with the same buckets are
    joined, windowed and grouped on keys that include ``key`` without moving a row.
    """
    spark = df.sparkSession
    buckets = bucket_count(spark)
    path = scratch_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    return name


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The written table cuts the lineage and survives the loss of executors, and every branch that
    reads it sees the same rows in the same slabs.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
