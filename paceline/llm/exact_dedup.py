"""Exact deduplication through an extendible-hash index kept in shared files.

A directory that doubles while a bucket is overfull deals 64-bit keys to buckets. Owner tasks take runs
of buckets, compare the texts under a key byte by byte, chain different ones, and write the entries of
their buckets; which row stays and how many are equal is read from there. Texts whose key no other row
has (all but those that a bit table of fixed size lets through) are entered by their digest alone, so
only possible copies are sent, combined per task first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from paceline.llm.bits import bit_table, with_chance
from paceline.session import scratch_path, staged

#: Entries (different texts) a bucket holds before the directory doubles.
BUCKET_ENTRIES = 16_384


def folded(text: Column) -> Column:
    """A-Z in lower case and nothing else; null becomes empty."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def prefix(key: Column, bits: int) -> Column:
    """The leading ``bits`` bits of a 64-bit key."""
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int = BUCKET_ENTRIES) -> DataFrame:
    """The extendible-hash directory over ``keys`` (column ``key``, one row per entry).

    One row per bucket: ``local_depth``, ``at`` (the leading ``local_depth`` bits that its keys
    share), ``bucket`` and ``n``. The directory starts one doubling short of what an even spread
    needs and doubles while a bucket is overfull. Only overfull buckets split; another keeps its
    depth. The slots that point to one bucket are a run of prefixes, so they are kept as that run
    and not written out. Entries under one key cannot be parted: such a bucket stays as it is.
    """
    total = keys.count()
    depth = max(0, math.ceil(math.log2(max(total, 1) / capacity)) - 1) if total > capacity else 0

    def measured(entries: DataFrame, bits: int) -> DataFrame:
        sizes = entries.groupBy(prefix(F.col("key"), bits).alias("at")).agg(
            F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        return sizes.withColumn("local_depth", F.lit(bits))

    buckets = staged(measured(keys, depth), "directory")
    while depth < 63:
        over = (F.col("n") > capacity) & (F.col("low") != F.col("high")) & (F.col("local_depth") == depth)
        if buckets.where(over).isEmpty():
            break
        full = buckets.where(over).select("at")
        halves = measured(keys.withColumn("at", prefix(F.col("key"), depth)).join(full, "at", "left_semi"), depth + 1)
        buckets = staged(buckets.where(~over).unionByName(halves), "directory")
        depth += 1
    low = F.when(F.col("local_depth") == 0, F.lit(0).cast("long")).otherwise(F.expr("shiftleft(at, 64 - local_depth)"))
    # Keys are ordered as unsigned numbers; the flipped sign makes that the order of the signed ones.
    low = low.bitwiseXOR(F.lit(-(1 << 63)))
    return buckets.select("local_depth", "at", "n", F.format_string("%d/%d", "local_depth", "at").alias("bucket"), low.alias("low"))


def owned_by(entries: DataFrame, slots: DataFrame) -> DataFrame:
    """Add the ``bucket`` of each entry's ``key`` and the ``low``-est key of it; the directory has few different local depths."""
    depths = [r.local_depth for r in slots.select("local_depth").distinct().collect()]
    if not depths:
        return entries.withColumn("bucket", F.lit(None).cast("string")).withColumn("low", F.lit(None).cast("long"))
    ways = [F.struct(F.lit(d).alias("local_depth"), prefix(F.col("key"), d).alias("at")) for d in sorted(depths)]
    tried = entries.withColumn("_way", F.explode(F.array(*ways)))
    here = [F.col("_way.local_depth").alias("local_depth"), F.col("_way.at").alias("at")]
    return tried.select(*entries.columns, *here).join(slots.drop("n"), ["local_depth", "at"]).drop("local_depth", "at")


def build_index(log: DataFrame, texts: DataFrame, capacity: int = BUCKET_ENTRIES) -> DataFrame:
    """Build the index of ``texts`` (``doc_id``, ``key``, ``norm``) in the shared folder and read it.

    One entry per different text: ``bucket``, ``key``, ``chain`` (place among the texts that collide
    on the key), ``text_sha256``, ``keep_id``, ``group_size``. ``log`` has ``doc_id``, ``key`` and
    ``text_sha256`` of every row; the directory is sized from it. A text that a third of all rows hold
    reaches its owner as one row per task.
    """
    spark = log.sparkSession
    counts = staged(log.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key-counts")
    slots = directory(counts.select("key"), capacity)
    again = staged(bit_table(counts.where("n > 1"), F.col("key")), "repeated-keys")
    alone = with_chance(log, F.col("key"), again, "_may").where("NOT _may").select(
        "key", "text_sha256", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    # Combined on the map side alone: the task is part of the group, so rows of different tasks first meet at the owner.
    sent = with_chance(texts.withColumn("_task", F.spark_partition_id()), F.col("key"), again, "_may").where("_may")
    sent = sent.groupBy("_task", "key", "norm").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    owners = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Buckets are runs of keys: their lowest key orders them, and a bucket has one owner.
    at_owner = owned_by(sent.drop("_task"), slots).repartitionByRange(owners, "low")
    compared = at_owner.groupBy("low", "bucket", "key", "norm").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    chain = F.row_number().over(Window.partitionBy("low", "key").orderBy("text_sha256"))
    chained = compared.withColumn("text_sha256", F.sha2("norm", 256)).withColumn("chain", chain)
    columns = ["bucket", "key", "chain", "text_sha256", "keep_id", "group_size"]
    path = scratch_path(spark, "extendible-index")
    chained.select(*columns).write.parquet(path)
    owned_by(alone, slots).withColumn("chain", F.lit(1)).select(*columns).write.mode("append").parquet(path)
    return spark.read.schema(chained.select(*columns).schema).parquet(path)


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = BUCKET_ENTRIES
) -> DataFrame:
    """One row per document: which row of its group of equal texts stays.

    Returns ``doc_id``, ``keep_id`` (largest id of the group), ``group_size``, ``kept``,
    ``text_sha256``, ``bucket``, ``chain``. Texts are equal when they are identical after A-Z are
    lower-cased; null counts as empty. A null id never wins against another; in a group of null ids
    alone ``keep_id`` is null. Of rows repeated with one id and equal text exactly one is kept.
    Other columns are not carried. An empty table gives an empty result.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), folded(F.col(text_col)).alias("norm"))
    texts = read.select("doc_id", F.xxhash64("norm").alias("key"), "norm")
    log = staged(texts.select("doc_id", "key", F.sha2("norm", 256).alias("text_sha256")), "dedup-log")
    index = build_index(log, texts, capacity)
    rows = log.groupBy("doc_id", "key", "text_sha256").agg(F.count(F.lit(1)).alias("_copies"))
    found = rows.join(index, ["key", "text_sha256"])
    each = found.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_nth") == 1)
    return each.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), kept.alias("kept"),
                       "text_sha256", "bucket", "chain")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that exact deduplication keeps.

    Of rows repeated with one id and equal text the one with the smallest values stays.
    """
    verdict = exact_dedup(docs, id_col, text_col)
    sha = F.sha2(folded(F.col(text_col)), 256)
    gone = verdict.groupBy("doc_id", "text_sha256").agg(
        F.max("kept").alias("_stays"), F.count(F.lit(1)).alias("_copies")
    ).where(~F.col("_stays") | (F.col("_copies") > 1))
    gone = staged(gone.withColumnRenamed("text_sha256", "_gone_sha").withColumnRenamed("doc_id", "_gone_id"), "dropped")
    # Only rows whose id may be among the dropped ones are sent to the join.
    name = F.xxhash64(F.col(id_col))
    table = staged(bit_table(gone, F.xxhash64("_gone_id")), "dropped-ids")
    marked = with_chance(docs.withColumn("_name", name), F.col("_name"), table, "_may").drop("_name")
    sure, maybe = marked.where("NOT _may").drop("_may"), marked.where("_may").drop("_may").withColumn("_sha", sha)
    same = (F.col("_sha") == F.col("_gone_sha")) & F.col(id_col).eqNullSafe(F.col("_gone_id"))
    left = sure.unionByName(maybe.join(gone, same, "left_anti").drop("_sha"))
    again = gone.where("_stays")
    if again.isEmpty():
        return left
    row = F.min(F.struct(*docs.columns)).alias("_row")
    one = maybe.join(again, same, "left_semi").groupBy(F.col(id_col).alias("_id"), "_sha").agg(row).select("_row.*")
    return left.unionByName(one)
