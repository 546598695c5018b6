"""Capture planning and Structured Streaming over the snapshot feed (2.15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from paceline.functions.moments import minus_minutes, month_of
from paceline.keys import CAPTURE_OFFSETS, COMBO, RACE, VENUE_DAY
from paceline.operators.dedup import newest_per_key
from paceline.session import scratch_path

# Minutes of tolerance for a late capture, minutes before the start for line-up checks.
MISS_TOLERANCE_MIN = 2
LINEUP_LEADS_MIN = [120, 60, 30, 10]

# --- planning (batch) --------------------------------------------------------------------------


def plan_captures(races: DataFrame, captured: DataFrame, now: Column, offsets: Sequence[float] = CAPTURE_OFFSETS) -> DataFrame:
    """Captures still to be made: race × offset without what is logged or more than two minutes past."""
    offset = F.explode(F.array(*[F.lit(o) for o in offsets]))
    plan = races.where(F.col("start_dt").isNotNull()).withColumn("target_offset_min", offset).withColumn(
        "due", minus_minutes(F.col("start_dt"), F.col("target_offset_min")))
    todo = plan.join(captured.select(*RACE, "target_offset_min").distinct(), [*RACE, "target_offset_min"], "left_anti")
    return todo.where(F.col("due") > minus_minutes(now, F.lit(float(MISS_TOLERANCE_MIN))))


def plan_lineup_checks(races: DataFrame, have: DataFrame, now: Column, leads: Sequence[int] = LINEUP_LEADS_MIN) -> DataFrame:
    """Checks per venue before its first unstarted race without a line-up; past ones collapse to now."""
    open_races = races.join(have.select(*RACE).distinct(), RACE, "left_anti").where(F.col("start_dt") > now)
    first = open_races.groupBy(*VENUE_DAY).agg(F.min("start_dt").alias("first_start"))
    # now may depend on the day only, so it can be taken per venue after the aggregation.
    dues = F.array_sort(F.array_distinct(F.array(*[F.greatest(minus_minutes(F.col("first_start"), F.lit(float(m))), now) for m in leads])))
    plan = first.withColumn("_dues", dues).select(*VENUE_DAY, F.element_at("_dues", -1).alias("_end"), F.explode("_dues").alias("due"))
    return plan.select(*VENUE_DAY, "due", (F.col("due") == F.col("_end")).alias("last"))


# --- streams -----------------------------------------------------------------------------------


def file_stream(spark: SparkSession, folder: str, name: str, schema) -> DataFrame:
    """New files of one table in a folder as a stream."""
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def run_available(writer: DataStreamWriter, spark: SparkSession) -> None:
    """Process what has arrived, with a checkpoint in the shared folder, and stop."""
    q = writer.option("checkpointLocation", scratch_path(spark, "stream")).trigger(availableNow=True).start()
    q.awaitTermination()


def to_files(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataStreamWriter:
    out = df.writeStream.format("parquet").outputMode("append").option("path", path)
    return out.partitionBy(*partition_by) if partition_by else out


def ingest_odds(snaps: DataFrame, path: str) -> DataStreamWriter:
    """Append snapshots to the month partition of their race day as they arrive."""
    return to_files(snaps.withColumn("race_month", month_of(F.col("race_date"))), path, ["race_month"])


def dedup_captures(log: DataFrame, delay: str = "2 hours") -> DataFrame:
    """One row per (race, offset); keys are forgotten once the watermark has passed them."""
    return log.withWatermark("event_time", delay).dropDuplicatesWithinWatermark([*RACE, "target_offset_min"])


def write_latest_price(snaps: DataFrame, path: str, delay: str = "1 day") -> DataStreamWriter:
    """Newest price per combination and event day, written as it changes.

    State is kept per event day and leaves with the watermark; ``latest_price`` reduces the written
    changes to one row per combination.
    """
    newest = F.max(F.struct("snapshot_dt", "l_partkey", "l_suppkey", "odds", "popularity", "target_offset_min")).alias("top")
    live = snaps.where(F.col("odds") > 0).withWatermark("event_time", delay)
    days = live.groupBy(F.window("event_time", "1 day").alias("w"), *COMBO).agg(newest).select(*COMBO, "top.*")

    def land(batch: DataFrame, batch_id: int) -> None:
        # A replayed batch overwrites its own folder.
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return days.writeStream.outputMode("update").foreachBatch(land)


def latest_price(spark: SparkSession, path: str, ties: Sequence[str]) -> DataFrame:
    rows = spark.read.parquet(path)
    return newest_per_key(rows, COMBO, [F.col("snapshot_dt"), *[F.col(t) for t in ties]], ["odds", "snapshot_dt"])


def overround_windows(snaps: DataFrame, width: str = "1 minute", delay: str = "5 minutes") -> DataFrame:
    """Inverse price total per race and tumbling window, final once the watermark has passed it."""
    live = snaps.where(F.col("odds") > 0).withWatermark("event_time", delay)
    return live.groupBy(F.window("event_time", width).alias("w"), *RACE).agg(
        F.sum(1 / F.col("odds")).alias("overround"), F.count(F.lit(1)).alias("n")
    ).select(F.col("w.start").alias("window_start"), *RACE, "overround", "n")


def capture_health(attempts: DataFrame, width: str = "10 minutes", slide: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """ok / no_odds / fail and mean lag by offset over sliding windows."""
    hit = lambda s: F.count(F.when(F.col("status") == s, 1)).alias(f"n_{s}")
    return attempts.withWatermark("event_time", delay).groupBy(
        F.window("event_time", width, slide).alias("w"), "target_offset_min"
    ).agg(hit("ok"), hit("no_odds"), hit("fail"), F.avg("lag_sec").alias("mean_lag")).select(
        F.col("w.start").alias("window_start"), "target_offset_min", "n_ok", "n_no_odds", "n_fail", "mean_lag")


def split_late(log: DataFrame, path: str) -> DataStreamWriter:
    """Captures made after the start go to ``side=late``, all others to ``side=main``, in one pass per batch."""
    after = F.coalesce(F.col("seconds_before_start") < 0, F.lit(False))
    sided = log.withColumn("side", F.when(after, "late").otherwise("main"))

    def land(batch: DataFrame, batch_id: int) -> None:
        # A replayed batch overwrites its own folder.
        batch.write.mode("overwrite").partitionBy("side").parquet(f"{path}/batch={batch_id}")

    return sided.writeStream.outputMode("append").foreachBatch(land)


def reschedule(planned: DataFrame, program: DataFrame) -> DataFrame:
    """Planned captures against the latest program: moved races get a new time, removed and run ones are dropped.

    A race that is in the program without a start keeps its old one. A program column ``has_result``,
    where there is one, marks races that have been run.
    """
    run = F.coalesce(F.col("has_result"), F.lit(False)) if "has_result" in program.columns else F.lit(False)
    latest = program.select(*RACE, F.col("start_dt").alias("new_start"), (~run).alias("_open"))
    out = planned.join(latest, RACE, "left")
    still = F.coalesce("_open", F.lit(False))
    start = F.when(still, F.coalesce("new_start", "start_dt"))
    action = F.when(~still, "dropped").when(start != F.col("start_dt"), "moved").otherwise("kept")
    out = out.withColumn("new_start", start).withColumns({"action": action, "due": minus_minutes(start, F.col("target_offset_min"))})
    return out.drop("_open")
