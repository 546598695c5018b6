"""The driver tables read as domain tables.

Race = order, venue = customer nation, runner = latest line item per line number, odds snapshots and
capture attempts = raw line items. Each function has a twin of the same name in ``sqlkit``.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from paceline.functions.regions import PREFECTURES
from paceline.functions.rows import inline_rows
from paceline.functions.numeric import settle
from paceline.keys import CAPTURE_OFFSETS, CAR, RACE, VENUE_DAY
from paceline.operators.combos import harville_pairs
from paceline.operators.dedup import newest_per_key
from paceline.session import bucket_count, bucketed


_LANDED: dict[tuple[str, str, str], str] = {}


def landed(fn):
    """Land a domain table once per application and read it from there, as the daily load would.

    The table is written to the shared folder in Parquet, so later reads prune columns and push
    filters down, and the loss of an executor costs no recomputation. It is bucketed by race, so
    joins, windows and aggregations within a race need no shuffle; for joins on a race and more,
    the session is told that the race alone will do.
    """

    @functools.wraps(fn)
    def read(spark: SparkSession, sf: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf, fn.__name__)
        if key not in _LANDED:
            _LANDED[key] = bucketed(fn(spark, sf), fn.__name__, "race_no")
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        return spark.table(_LANDED[key])

    return read


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@landed
def races(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    key = F.col("o_orderkey")
    return o.join(c, "o_custkey").select(
        F.to_date("o_orderdate").alias("race_date"),
        F.col("c_nationkey").alias("place_code"),
        key.alias("race_no"),
        F.format_string("%02d:%02d", 8 + key % 15, (key * 7) % 60).alias("st_time"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("total"),
        F.col("c_mktsegment").alias("segment"),
    )


def race_keys(spark: SparkSession, sf: str) -> DataFrame:
    return races(spark, sf).select(*RACE)


def meta(spark: SparkSession, sf: str) -> DataFrame:
    """race_meta: one row per venue-day."""
    off = (F.col("priority") == "1-URGENT") & (F.col("status") == "P")
    return (
        races(spark, sf)
        .groupBy(*VENUE_DAY)
        .agg(F.min("segment").alias("grade"), F.max(off.cast("int")).alias("off"))
        .select(*VENUE_DAY, "grade", F.when(F.col("off") == 1, "True").otherwise("False").alias("is_canceled"))
    )


def raw_lines(spark: SparkSession, sf: str, feed: DataFrame | None = None) -> DataFrame:
    """Line items (the table, or a stream of it) with the race key."""
    li = table(spark, sf, "lineitem") if feed is None else feed
    return li.withColumnRenamed("l_orderkey", "race_no").join(race_keys(spark, sf), "race_no")


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus"]


def latest_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The rows are dealt by race first: a struct is aggregated by sorting, and a whole split of the table
    would be sorted, and spilled, in front of the shuffle."""
    li = table(spark, sf, "lineitem").repartition(bucket_count(spark), "l_orderkey")
    return newest_per_key(li, ["l_orderkey", "l_linenumber"], LINE_ORDER, LINE_ORDER)


@landed
def runners(spark: SparkSession, sf: str) -> DataFrame:
    """race_entries and race_stats in one: one row per (race, car)."""
    li = latest_lines(spark, sf).withColumnRenamed("l_orderkey", "race_no")
    r = races(spark, sf).select(*RACE, "st_time", "status")
    qty = F.col("l_quantity").cast("int")
    names = F.array(*[F.lit(p) for p in PREFECTURES])
    return li.join(r, "race_no").select(
        *RACE,
        F.col("l_linenumber").alias("car_no"),
        "st_time",
        "status",
        F.col("l_partkey").alias("player_code"),
        F.element_at(names, (F.col("l_suppkey") % len(PREFECTURES) + 1).cast("int")).alias("prefecture"),
        F.col("l_suppkey").alias("supplier"),
        F.when(F.col("l_returnflag") == "A", "逃").when(F.col("l_returnflag") == "N", "追").otherwise("両").alias("kyaku"),
        F.when(F.col("l_linestatus") == "O", "S1").otherwise("A1").alias("kyuhan"),
        F.nullif(F.col("l_discount") * 100, F.lit(0.0)).alias("syouritu"),
        (F.col("l_tax") * 100).alias("rentairitu2"),
        F.col("l_quantity").alias("rentairitu3"),
        (F.col("l_extendedprice") / 1000).alias("heikin_tokuten"),
        qty.alias("age"),
        (qty % 7).alias("nige_cnt"),
        (qty % 5).alias("makuri_cnt"),
        (F.col("l_suppkey") % 4).cast("int").alias("sasi_cnt"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("qty"),
        F.col("l_discount").alias("disc"),
        F.col("l_tax").alias("tax"),
        F.to_date("l_shipdate").alias("ship_date"),
    )


def narabi(spark: SparkSession, sf: str) -> DataFrame:
    """race_lines: position and bundle per car; tables of half the riders only."""
    return runners(spark, sf).select(
        *CAR,
        (F.col("car_no") + (F.col("qty") / 25).cast("int")).alias("narabi_x"),
        F.when(F.col("kyuhan") == "S1", 1).otherwise(0).alias("narabi_y"),
    )


@landed
def results(spark: SparkSession, sf: str) -> DataFrame:
    """race_results: finish order by quantity; no discount = no finish; open races have no rows."""
    w = Window.partitionBy(*RACE).orderBy(F.desc("qty"), "car_no")
    return (
        runners(spark, sf)
        .where(F.col("status") != "P")
        .select(*CAR, "qty", "disc")
        .withColumn("rank", F.row_number().over(w))
        .select(*CAR, F.when(F.col("disc") != 0, F.col("rank")).alias("tyaku"))
    )


@landed
def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Scores per car, six digits, each adding up to about one in a race."""
    w = Window.partitionBy(*RACE)

    def part(x: Column) -> Column:
        return settle(x / F.sum(x).over(w), 6)

    return runners(spark, sf).select(
        *CAR,
        part(F.col("price")).alias("p_win"),
        part(F.col("qty")).alias("p_top2"),
        part(F.col("price") * F.col("qty")).alias("p_top3"),
        "ship_date",
    )


@landed
def payouts(spark: SparkSession, sf: str) -> DataFrame:
    """Winning combinations per race and bet type; open 5-LOW races are not paid yet."""
    paid = races(spark, sf).where(
        (F.col("status") == "F") | ((F.col("status") == "O") & (F.col("priority") != "5-LOW"))
    ).select(*RACE, (F.floor(F.col("total") / 1000).cast("int") + 100).alias("base"))
    w = Window.partitionBy(*RACE).orderBy("tyaku")
    done = results(spark, sf).where(F.col("tyaku").isNotNull()).withColumn("r", F.row_number().over(w))
    podium = done.where(F.col("r") <= 3).groupBy(*RACE).agg(
        *[F.max(F.when(F.col("r") == i, F.col("car_no"))).alias(f"c{i}") for i in (1, 2, 3)]
    )
    c1, c2, c3, base = F.col("c1"), F.col("c2"), F.col("c3"), F.col("base")

    def pair(a: Column, b: Column) -> Column:
        return F.concat_ws("=", F.least(a, b), F.greatest(a, b))

    trio = F.array_join(F.array_sort(F.array(c1, c2, c3)).cast("array<string>"), "=")
    tickets = inline_rows(
        ["bet_type", "kumi_ban", "payout", "need"],
        ["SH2", pair(c1, c2), base, c2],
        ["ST2", F.concat_ws("-", c1, c2), base * 2, c2],
        ["RH3", trio, base * 3, c3],
        ["RT3", F.concat_ws("-", c1, c2, c3), base * 6, c3],
        ["W", pair(c1, c2), base, c3],
        ["W", pair(c1, c3), base + 10, c3],
        ["W", pair(c2, c3), base + 20, c3],
    )
    return podium.join(paid, RACE).select(*RACE, tickets).where(F.col("need").isNotNull()).drop("need")


@landed
def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """race_odds_prerace: every line item quotes one combination at one time."""
    return snapshot_rows(raw_lines(spark, sf))


def snapshot_rows(lines: DataFrame) -> DataFrame:
    car, step = F.col("l_linenumber"), (F.col("l_partkey") % 6 + 1).cast("int")
    flag = F.concat("l_returnflag", "l_linestatus")
    b = (car - 1 + step) % 7 + 1
    c = (car - 1 + step % 6 + 1) % 7 + 1
    bet = (
        F.when(flag == "AF", "ST2").when(flag == "AO", "SH2").when(flag == "NF", "W")
        .when(flag == "NO", "RH3").when(flag == "RF", "RT3").otherwise("ST2")
    )
    base = lines.withColumn("bet_type", bet).withColumn("b", b).withColumn("c", c)
    trio = F.array(car, F.col("b"), F.col("c"))
    kumi = (
        F.when(F.col("bet_type") == "ST2", F.concat_ws("-", car, "b"))
        .when(F.col("bet_type") == "RT3", F.concat_ws("-", car, "b", "c"))
        .when(F.col("bet_type") == "RH3", F.array_join(F.array_sort(trio).cast("array<string>"), "="))
        .otherwise(F.concat_ws("=", F.least(car, "b"), F.greatest(car, "b")))
    )
    odds = 1 + F.floor(F.col("l_extendedprice") / 1000) / 10
    return base.select(
        *RACE,
        "bet_type",
        kumi.alias("kumi_ban"),
        F.when(F.col("l_tax") == 0.08, 0.0).otherwise(odds).alias("odds"),
        F.when(F.col("bet_type") == "W", odds + F.round(F.col("l_discount") * 20, 1)).alias("max_odds"),
        F.col("l_quantity").cast("int").alias("popularity"),
        F.col("l_shipdate").alias("snapshot_dt"),
        offset_of("l_quantity").alias("target_offset_min"),
        "l_partkey",
        "l_suppkey",
    )


SNAP_TIES = ["l_partkey", "l_suppkey", "odds", "popularity", "target_offset_min"]


def offset_of(qty: str) -> Column:
    """Quantity 1..50 in five equal steps to the five capture offsets."""
    offsets = F.array(*[F.lit(o) for o in CAPTURE_OFFSETS])
    return F.element_at(offsets, F.least(F.floor((F.col(qty) - 1) / 10), F.lit(4)).cast("int") + 1)


def market(spark: SparkSession, sf: str) -> DataFrame:
    """A complete price list per race from the win scores: ST2, SH2 and W (with a price range).

    It is not landed: it has many rows per car and follows from the bucketed scores without a shuffle.
    """
    pairs = harville_pairs(predictions(spark, sf).select(*CAR, "p_win"))
    st_sh = pairs.where(F.col("p_combo") > 0).select(
        *RACE, "bet_type", "kumi_ban", (0.75 / F.col("p_combo")).alias("odds")
    )
    wide = F.col("bet_type") == "SH2"
    quotes = inline_rows(
        ["bet", "price", "max_odds"],
        [F.col("bet_type"), F.col("odds"), F.lit(None).cast("double")],
        [F.when(wide, "W"), F.col("odds") * 0.4, F.col("odds") * 0.7],
    )
    return (
        st_sh.select(*RACE, "kumi_ban", quotes).where(F.col("bet").isNotNull())
        .select(*RACE, F.col("bet").alias("bet_type"), "kumi_ban", F.col("price").alias("odds"), "max_odds")
    )


def market_by_offset(spark: SparkSession, sf: str) -> DataFrame:
    """The price list at the five capture offsets; earlier prices drift with the race's total."""
    drift = races(spark, sf).select(*RACE, ((F.col("total") / 500000 - 0.5) / 10).alias("drift"))
    offsets = F.array(*[F.lit(o) for o in CAPTURE_OFFSETS])
    moved = 1 + F.col("drift") * F.col("target_offset_min")
    return (
        market(spark, sf).join(drift, RACE)
        .withColumn("target_offset_min", F.explode(offsets))
        .select(*RACE, "bet_type", "kumi_ban", (F.col("odds") * moved).alias("odds"),
                (F.col("max_odds") * moved).alias("max_odds"), "target_offset_min")
    )


@landed
def capture_log(spark: SparkSession, sf: str) -> DataFrame:
    """prerace_snapshot_log: one capture attempt per line item."""
    return capture_rows(spark, sf, raw_lines(spark, sf))


def capture_rows(spark: SparkSession, sf: str, lines: DataFrame) -> DataFrame:
    start = races(spark, sf).select(
        "race_no", F.to_timestamp_ntz(F.concat_ws(" ", "race_date", "st_time"), F.lit("yyyy-MM-dd HH:mm")).alias("start_dt")
    )
    lag = F.when(F.col("l_discount") != 0.1, F.round(F.col("l_tax") * 500 - 5, 1))
    off = F.col("target_offset_min")
    late = F.coalesce(F.col("capture_lag_sec"), F.lit(0.0))
    us = lambda sec: F.make_dt_interval(secs=sec.cast("decimal(18,6)"))
    return (
        lines.join(start, "race_no")
        .withColumn("target_offset_min", offset_of("l_quantity"))
        .withColumn("capture_lag_sec", lag)
        .select(
            *RACE, F.col("l_linenumber").alias("car_no"), "start_dt", "target_offset_min",
            F.when(F.col("l_returnflag") != "N", "ok").when(F.col("l_linestatus") == "O", "no_odds").otherwise("fail").alias("status"),
            F.col("l_quantity").cast("int").alias("n_rows"),
            (F.col("start_dt") - us(off * 60)).alias("scheduled_snapshot_dt"),
            (F.col("start_dt") - us(off * 60 - late)).alias("snapshot_dt"),
            F.when(F.col("capture_lag_sec").isNotNull(), off * 60 - F.col("capture_lag_sec")).alias("seconds_before_start"),
            "capture_lag_sec",
            F.round(F.col("l_discount") * 30, 1).alias("fetch_sec"),
            "l_partkey", "l_suppkey",
        )
    )


def voids(spark: SparkSession, sf: str) -> DataFrame:
    """void_races: a NULL race number stands for the whole venue-day."""
    return races(spark, sf).where(
        (F.col("status") == "P") & F.col("priority").isin("2-HIGH", "3-MEDIUM")
    ).select(
        "race_date", "place_code",
        F.when(F.col("priority") == "3-MEDIUM", F.col("race_no")).alias("race_no"),
        F.when(F.col("priority") == "3-MEDIUM", "full_refund").otherwise("day_canceled").alias("reason"),
    )


def official_runs(spark: SparkSession, sf: str) -> DataFrame:
    """shadow_predictions: every raw line item is one prediction of one run."""
    return raw_lines(spark, sf).select(
        *RACE, F.col("l_linenumber").alias("car_no"),
        settle(F.col("l_extendedprice") / 110000, 6).alias("p_win"),
        F.col("l_shipdate").alias("predicted_at"),
        F.when(F.col("l_returnflag") == "A", "official").when(F.col("l_returnflag") == "N", "rerun")
        .otherwise("legacy_unverifiable").alias("run_type"),
        "l_partkey", "l_suppkey", "l_quantity",
    )
