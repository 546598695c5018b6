"""Scans, appends, partitions and ledgers (2.1) over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.keys import CAR, COMBO, RACE, VENUE_DAY
from paceline.plans import bindings as b
from paceline.plans.registry import query
from paceline.session import scratch_path
from paceline.sources import tables as tb

R = "race_date, place_code, race_no"
SNAP = f"{R}, bet_type, kumi_ban, odds, max_odds, popularity, snapshot_dt, target_offset_min"
SNAP_COLS = [*COMBO, "odds", "max_odds", "popularity", "snapshot_dt", "target_offset_min"]


def store(spark, sf):
    """The snapshot table loaded into a monthly store in two batches."""
    path = scratch_path(spark, "store")
    s = b.snapshots(spark, sf)
    tb.append_snapshots(s.where(F.col("bet_type") == "W"), path, "wide")
    tb.append_snapshots(s.where(F.col("bet_type") != "W"), path, "other")
    return path


@query("scan_table", f"SELECT {R}, car_no, tyaku, CAST(NULL AS VARCHAR) AS kimarite FROM results", dt="race_date")
def _(spark, sf):
    root = scratch_path(spark, "csv")
    tb.append_rows(b.results(spark, sf), root, "race_results")
    return tb.scan_table(spark, root, "race_results").select(*CAR, "tyaku", "kimarite")


@query("scan_headerless", f"SELECT {R}, bet_type, kumi_ban, odds, max_odds, popularity FROM snapshots", dbl="odds max_odds", dt="race_date")
def _(spark, sf):
    path = scratch_path(spark, "headerless")
    tb.conform(b.snapshots(spark, sf), "race_odds").write.csv(path)
    return tb.scan_headerless(spark, path, "race_odds").select(*COMBO, "odds", "max_odds", "popularity")


@query("scan_partitions", f"SELECT {SNAP} FROM snapshots WHERE race_date BETWEEN DATE '1998-05-10' AND DATE '1999-02-20'",
       dbl="odds max_odds target_offset_min", dt="race_date", ts="snapshot_dt")
def _(spark, sf):
    return tb.scan_partitions(spark, store(spark, sf), "1998-05-10", "1999-02-20", SNAP_COLS)


@query("scan_rows_stream", f"SELECT {R}, bet_type, kumi_ban, odds FROM snapshots WHERE race_date >= DATE '2000-06-15'", dbl="odds", dt="race_date")
def _(spark, sf):
    return tb.scan_partitions(spark, store(spark, sf), start="2000-06-15", columns=[*COMBO, "odds"])


@query("row_count", "SELECT count(*) AS n_rows FROM snapshots")
def _(spark, sf):
    return tb.row_count(b.snapshots(spark, sf))


@query("append_rows", f"SELECT {R}, bet_type, kumi_ban, payout, CAST(NULL AS VARCHAR) AS bet_name FROM payouts UNION ALL SELECT {R}, bet_type, kumi_ban, payout, NULL FROM payouts WHERE bet_type = 'W'",
       dt="race_date")
def _(spark, sf):
    root, p = scratch_path(spark, "append"), b.payouts(spark, sf)
    tb.append_rows(p, root, "payouts")
    tb.append_rows(p.where(F.col("bet_type") == "W").withColumn("extra", F.lit(1)), root, "payouts")
    return tb.scan_table(spark, root, "payouts").select(*COMBO, "payout", "bet_name")


@query("exists_key", """
SELECT m.race_date, m.place_code, s.race_date IS NOT NULL AS loaded FROM meta m LEFT JOIN (SELECT DISTINCT race_date, place_code FROM payouts) s
ON m.race_date = s.race_date AND m.place_code = s.place_code""", dt="race_date")
def _(spark, sf):
    return tb.existing_keys(b.meta(spark, sf).select(*VENUE_DAY), b.payouts(spark, sf), VENUE_DAY)


@query("exists_key_sizes", """
SELECT 'race_meta' AS table_name, count(*) AS n_keys FROM meta UNION ALL SELECT 'race_entries', count(DISTINCT (race_date, place_code)) FROM runners
UNION ALL SELECT 'race_results', count(DISTINCT (race_date, place_code)) FROM results""")
def _(spark, sf):
    return tb.key_sizes({"race_meta": b.meta(spark, sf), "race_entries": b.runners(spark, sf), "race_results": b.results(spark, sf)}, VENUE_DAY)


@query("partition_migrate", """
SELECT month, n AS n_in, n AS n_out, true AS agrees FROM (SELECT CASE WHEN odds = 0 THEN 'bad' ELSE strftime(race_date, '%Y-%m') END AS month, count(*) AS n
FROM snapshots GROUP BY 1)""")
def _(spark, sf):
    s = b.snapshots(spark, sf)
    # Rows without a price get a broken date, as a torn write would leave it.
    legacy = s.withColumn("race_date", F.when(F.col("odds") == 0, F.lit("20x1-02-30")).otherwise(F.col("race_date").cast("string")))
    path, side = scratch_path(spark, "months"), scratch_path(spark, "quarantine")
    tb.partition_migrate(legacy, path, side, "first")
    return tb.partition_migrate(legacy, path, side, "first")


@query("dedup_latest_closed", f"""
SELECT {R}, bet_type, kumi_ban, odds, popularity, snapshot_dt, target_offset_min FROM snapshots WHERE odds > 0
QUALIFY row_number() OVER (PARTITION BY {R}, bet_type, kumi_ban ORDER BY snapshot_dt DESC, target_offset_min DESC, odds DESC, max_odds DESC, popularity DESC) = 1""",
       dbl="odds target_offset_min", dt="race_date", ts="snapshot_dt")
def _(spark, sf):
    path, latest = store(spark, sf), scratch_path(spark, "closed")
    tb.close_months(spark, path, latest, "1996-01", ["target_offset_min"])
    # A late batch of one bet type: its closed months are read from the store again until they are closed anew.
    s = b.snapshots(spark, sf)
    tb.append_snapshots(s.where((F.col("bet_type") == "W") & (F.col("race_date") < F.lit("1994-01-01").cast("date"))), path, "late")
    return tb.scan_latest(spark, path, latest, ["target_offset_min"]).select(*COMBO, "odds", "popularity", "snapshot_dt", "target_offset_min")


@query("salvage_rows", f"SELECT {R}, bet_type, kumi_ban, odds FROM snapshots WHERE bet_type = 'ST2'", dbl="odds", dt="race_date")
def _(spark, sf):
    path = scratch_path(spark, "torn")
    text = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in
                              [*RACE, "bet_type", "kumi_ban", "odds", "max_odds", "popularity"]], F.lit(""))
    torn = F.when(F.col("bet_type") == "ST2", text).otherwise(F.substring(text, 5, 1000))
    b.snapshots(spark, sf).select(torn.alias("value")).write.text(path)
    return tb.salvage_rows(spark, path, "race_odds").select(*COMBO, "odds")


@query("merge_replace", f"SELECT {R}, car_no, CASE WHEN race_date < DATE '2000-01-01' THEN p_win ELSE p_top2 END AS p_win FROM predictions", dbl="p_win", dt="race_date")
def _(spark, sf):
    p = b.predictions(spark, sf)
    new = p.where(F.col("race_date") >= F.lit("2000-01-01").cast("date")).select(F.col("p_top2").alias("p_win"), *CAR)
    return tb.merge_replace(p.select(*CAR, "p_win"), new, "2000-01-01")


@query("fill_missing", f"""
SELECT {R}, car_no, p_win FROM predictions p WHERE race_date < DATE '1999-01-01' OR race_date >= DATE '2000-01-01' OR race_no IN (SELECT race_no FROM payouts)
UNION ALL SELECT {R}, car_no, -1 FROM predictions WHERE race_date > DATE '1999-03-01' AND race_date < DATE '2000-01-01' AND race_no NOT IN (SELECT race_no FROM payouts)""",
       dbl="p_win", dt="race_date")
def _(spark, sf):
    p = b.predictions(spark, sf).select(*CAR, "p_win")
    year = (F.col("race_date") >= F.lit("1999-01-01").cast("date")) & (F.col("race_date") < F.lit("2000-01-01").cast("date"))
    existing = p.where(~year).unionByName(p.where(year).join(b.payouts(spark, sf).select(*RACE), RACE, "left_semi").select(*p.columns))
    return tb.fill_missing(p.withColumn("p_win", F.lit(-1.0)), existing, "1999-03-01", "2000-01-01")


@query("append_history", """
SELECT strftime(race_date, '%Y-%m') AS month, count(*) AS n, CAST(NULL AS DOUBLE) AS total FROM races WHERE race_date < DATE '2000-01-01' GROUP BY 1
UNION ALL SELECT strftime(race_date, '%Y-%m'), count(*), sum(total) FROM races WHERE race_date >= DATE '2000-01-01' GROUP BY 1""", dbl="total")
def _(spark, sf):
    r, cut = b.races(spark, sf), F.lit("2000-01-01").cast("date")
    month = F.date_format("race_date", "yyyy-MM").alias("month")
    old = r.where(F.col("race_date") < cut).groupBy(month).agg(F.count(F.lit(1)).alias("n"))
    new = r.where(F.col("race_date") >= cut).groupBy(month).agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("total"))
    return tb.append_history(old, new)


@query("keyed_insert", """
SELECT race_date, place_code, race_no, 'full_refund' AS reason FROM voids WHERE reason = 'full_refund'
UNION ALL SELECT DISTINCT race_date, place_code, race_no, 'day_canceled' FROM voids WHERE reason = 'day_canceled'""", dt="race_date")
def _(spark, sf):
    v = b.voids(spark, sf)
    ledger = v.where(F.col("reason") == "full_refund")
    again = v.unionByName(v.withColumn("reason", F.lit("weather")).withColumn("place_code", F.col("place_code") + 100))
    return tb.keyed_insert(ledger, again, RACE, ["full_refund", "day_canceled"])
