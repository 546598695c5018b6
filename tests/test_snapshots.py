"""Price snapshots: monthly store, legacy table, dedup, migration (fixture F1)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paceline.keys import COMBO
from paceline.operators.dedup import dedup_latest, dup_key_count, exact_duplicates
from paceline.session import scratch_path
from paceline.sources import batches as vb, tables as tb

DAYS = ["2026-05-16", "2026-05-31", "2026-06-01", "2026-06-15", "2026-07-20", "2026-08-31", "2026-09-01", "2026-09-04"]
SCHEMA = ("race_date date, place_code int, race_no long, bet_type string, kumi_ban string, odds double, snapshot_dt timestamp_ntz, "
          "target_offset_min double")


def day_rows(day):
    out = []
    for race in (1, 2):
        for bet, sep in (("ST2", "-"), ("SH2", "=")):
            for k, pair in enumerate(("1 2", "1 3", "2 3")):
                combo = pair.replace(" ", sep)
                for off in (5.0, 3.0, 2.0, 1.0, 0.5):
                    at = dt.datetime.fromisoformat(f"{day} 10:00:00") - dt.timedelta(minutes=off)
                    out.append((day, 11, race, bet, combo, round(10 + k + 0.1 * off + race, 1), at, off))
    out.append((day, 11, 1, "ST2", "1-2", 0.0, dt.datetime.fromisoformat(f"{day} 09:59:59"), 0.5))
    return out


@pytest.fixture()
def snaps(frame):
    return frame(SCHEMA, [r for d in DAYS for r in day_rows(d)])


def as_set(df):
    return {tuple(r) for r in dedup_latest(df, ["target_offset_min"]).select(*COMBO, "odds", "target_offset_min").collect()}


@pytest.mark.parametrize("start,end", [(None, None), ("2026-06-10", "2026-08-31"), ("2026-07-01", "2026-07-31"), ("2027-01-01", "2027-12-31")])
def test_store_and_legacy_equal_the_single_table(spark, snaps, start, end):
    cut = F.lit("2026-07-01").cast("date")
    store = scratch_path(spark, "t")
    tb.append_snapshots(snaps.where(F.col("race_date") >= cut), store, "a")
    mixed = tb.scan_with_legacy(tb.scan_partitions(spark, store, start, end), snaps.where(F.col("race_date") < cut), start, end)
    single = snaps if start is None else snaps.where(F.col("race_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    assert as_set(mixed) == as_set(single)
    assert mixed.count() == single.count()


def test_latest_keeps_the_last_offset_and_ignores_zero_odds(snaps):
    rows = dedup_latest(snaps, ["target_offset_min"]).collect()
    assert len(rows) == len(DAYS) * 12 and {r["target_offset_min"] for r in rows} == {0.5} and min(r["odds"] for r in rows) > 0


def test_a_newer_row_changes_the_result(spark, frame, snaps):
    newer = frame(SCHEMA, [("2026-08-31", 11, 1, "ST2", "1-2", 99.9, dt.datetime(2026, 8, 31, 9, 59, 58), 0.5)])
    rows = dedup_latest(snaps.unionByName(newer), ["target_offset_min"]).where("race_date = '2026-08-31' AND race_no = 1 AND kumi_ban = '1-2'").collect()
    assert [r["odds"] for r in rows] == [99.9]


def test_partition_pruning_reaches_the_scan(spark, snaps):
    store = scratch_path(spark, "t")
    tb.append_snapshots(snaps, store, "a")
    plan = tb.scan_partitions(spark, store, "2026-06-10", "2026-08-31", ["odds"])._jdf.queryExecution().executedPlan().toString()
    assert "race_month" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "race_date" in plan.split("PushedFilters")[1].split("ReadSchema")[0]
    assert "kumi_ban" not in plan.split("ReadSchema")[1]


def test_migration_conserves_rows_and_repeats_safely(spark, snaps):
    text = snaps.withColumn("race_date", F.col("race_date").cast("string"))
    bad = text.limit(1).withColumn("race_date", F.lit("2026-13-99"))
    store, side = scratch_path(spark, "m"), scratch_path(spark, "q")
    first = tb.partition_migrate(text.unionByName(bad), store, side, "one").collect()
    again = tb.partition_migrate(text.unionByName(bad), store, side, "one").collect()
    assert all(r["agrees"] for r in first + again)
    assert {r["month"]: r["n_out"] for r in again} == {"2026-05": 122, "2026-06": 122, "2026-07": 61, "2026-08": 61, "2026-09": 122, "bad": 1}
    late = text.where("race_date = '2026-09-04'")
    assert all(r["agrees"] for r in tb.partition_migrate(late, store, side, "two").collect())
    assert tb.scan_partitions(spark, store).count() == snaps.count() + 61


def test_duplicate_payout_counts(frame):
    pay = frame("race_date date, place_code int, race_no long, bet_type string, kumi_ban string, payout int",
                [("2026-01-01", 1, 1, "W", "1=2", p) for p in (500, 500, 600)])
    assert dup_key_count(pay, COMBO).first()["n_surplus"] == 2
    assert exact_duplicates(pay).first().asDict() == {"n_before": 3, "n_after": 2, "n_removed": 1}
    assert dup_key_count(pay.dropDuplicates(), COMBO).first()["n_surplus"] == 1


def test_unknown_and_missing_tables(spark):
    from paceline.schemas import schema_for
    with pytest.raises(ValueError):
        schema_for("nope")
    assert schema_for("race_odds_prerace_2026-09") == schema_for("race_odds_prerace")
    empty = tb.scan_table(spark, scratch_path(spark, "none"), "payouts")
    assert empty.count() == 0 and empty.columns == schema_for("payouts").names


def test_keyed_insert_is_idempotent(frame):
    schema = "race_date date, place_code int, race_no long, reason string"
    ledger = frame(schema, [("2026-01-01", 1, None, "day_canceled")])
    rows = frame(schema, [("2026-01-01", 1, None, "day_canceled"), ("2026-01-01", 2, 3, "full_refund"), ("2026-01-02", 2, 3, "other")])
    keys = ["race_date", "place_code", "race_no"]
    once = tb.keyed_insert(ledger, rows, keys, ["day_canceled", "full_refund"])
    assert once.count() == 2 and tb.keyed_insert(once, rows, keys, ["day_canceled", "full_refund"]).count() == 2


def test_fill_missing_scores(frame):
    schema = "race_date date, place_code int, race_no long, p_win double"
    old = frame(schema, [("2026-10-01", 1, 1, 0.1)])
    fresh = frame(schema, [(d, 1, 1, 0.9) for d in ("2026-09-01", "2026-09-20", "2026-10-01", "2026-10-02")])
    out = {(str(r["race_date"]), r["p_win"]) for r in tb.fill_missing(fresh, old, "2026-09-13", "2026-10-02").collect()}
    assert out == {("2026-10-01", 0.1), ("2026-09-20", 0.9)}


def test_a_corrected_batch_leaves_no_stale_month(spark, tmp_path):
    schema = "race_date string, place_code int, race_no int, bet_type string, kumi_ban string, odds double"
    rows = [("1999-05-03", 1, 1, "W", "1=2", 2.0), ("1999-06-03", 1, 2, "W", "1=2", 3.0)]
    frame = lambda part: spark.createDataFrame(part, schema)
    store = str(tmp_path / "store")
    tb.append_snapshots(frame(rows), store, "b1")
    tb.append_snapshots(frame(rows[:1]), store, "b/2")
    tb.append_snapshots(frame(rows[1:]), store, "b1")
    got = sorted((str(r.race_date), r.race_no) for r in tb.scan_partitions(spark, store).collect())
    assert got == [("1999-05-03", 1), ("1999-06-03", 2)]
    assert [r.race_no for r in tb.scan_partitions(spark, store, "1999-06-01", "1999-06-30").collect()] == [2]


def test_a_corrected_quarantine_is_emptied(spark, tmp_path):
    schema = "race_date string, place_code int, race_no int, bet_type string, kumi_ban string, odds double"
    store, side = str(tmp_path / "store"), str(tmp_path / "side")
    bad = spark.createDataFrame([("never", 1, 1, "W", "1=2", 2.0), ("1999-06-03", 1, 2, "W", "1=2", 3.0)], schema)
    first = {r.month: (r.n_in, r.n_out) for r in tb.partition_migrate(bad, store, side, "b").collect()}
    assert first == {"bad": (1, 1), "1999-06": (1, 1)}
    again = {r.month: (r.n_in, r.n_out) for r in tb.partition_migrate(bad.where("race_no = 2"), store, side, "b").collect()}
    assert again == {"1999-06": (1, 1)}


def test_a_killed_load_leaves_the_old_batch(spark, snaps):
    store = scratch_path(spark, "t")
    tb.append_snapshots(snaps.where("race_no = 1"), store, "a")
    before = sorted(tuple(r) for r in tb.scan_partitions(spark, store, columns=COMBO).collect())
    # A load that ends before its commit: all files are there, nothing reads them.
    rows = tb.conform(snaps.where("race_no = 2"), "race_odds_prerace").withColumn("race_month", F.date_format("race_date", "yyyy-MM"))
    version = tb.write_months(rows, store)
    assert sorted(tuple(r) for r in tb.scan_partitions(spark, store, columns=COMBO).collect()) == before
    vb.commit_batch(tb.month_counts(spark, store, version), store, "a", version)
    assert {r.race_no for r in tb.scan_partitions(spark, store).collect()} == {2}
    assert vb.superseded(spark, store).count() == 1
    tb.append_snapshots(snaps.limit(0), store, "a")
    assert tb.scan_partitions(spark, store).count() == 0


def test_closed_months_equal_the_full_dedup_and_follow_their_versions(spark, snaps):
    store, latest = scratch_path(spark, "t"), scratch_path(spark, "l")
    tb.append_snapshots(snaps.where("target_offset_min > 1"), store, "a")
    tb.append_snapshots(snaps.where("target_offset_min <= 1"), store, "b")
    ties = ["target_offset_min"]

    def same(start=None, end=None):
        full = dedup_latest(tb.scan_partitions(spark, store, start, end), ties)
        out = tb.scan_latest(spark, store, latest, ties, start, end)
        assert sorted(map(str, out.select(*full.columns).collect())) == sorted(map(str, full.collect()))
        return out.count()

    assert same() > 0 and tb.close_months(spark, store, latest, "2026-08", ties) == ["2026-05", "2026-06", "2026-07"]
    assert same() == same("2026-05-01", "2026-09-30") and same("2026-05-20", "2026-06-10") > 0
    assert tb.close_months(spark, store, latest, "2026-08", ties) == []
    # A late file of June and a batch without May: only these two months are stale, and read right before they are closed again.
    later = snaps.where("race_date = '2026-06-15' AND odds > 0").withColumn("snapshot_dt", F.expr("snapshot_dt + interval 1 hour")).withColumn("odds", F.lit(99.0))
    tb.append_snapshots(later, store, "late")
    assert same("2026-06-01", "2026-06-30") > 0
    assert tb.scan_latest(spark, store, latest, ties).where("odds = 99").count() == 12
    assert tb.close_months(spark, store, latest, "2026-08", ties) == ["2026-06"] and same() > 0
    tb.append_snapshots(snaps.where("target_offset_min <= 1 AND race_date > '2026-06-01'"), store, "b")
    assert tb.close_months(spark, store, latest, "2026-09", ties) == ["2026-05", "2026-06", "2026-07", "2026-08"] and same() > 0


def test_migration_reads_the_legacy_table_once_and_keeps_rejected_rows_whole(spark, snaps, tmp_path):
    legacy = snaps.withColumn("race_date", F.col("race_date").cast("string")).withColumn("extra", F.lit("x"))
    torn = legacy.limit(2).withColumn("race_date", F.lit("20x1-02-30")).withColumn("odds", F.lit(None).cast("double"))
    far = legacy.limit(1).withColumn("race_date", F.lit("+12345-01-01"))
    table = str(tmp_path / "legacy")
    legacy.unionByName(torn).unionByName(far).unionByName(legacy.limit(1).withColumn("race_date", F.lit(None).cast("string"))).write.parquet(table)
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for batch in rows:
            seen.add(batch.num_rows)
            yield batch

    source = spark.read.parquet(table)
    store, side = scratch_path(spark, "m"), scratch_path(spark, "q")
    out = {r.month: (r.n_in, r.n_out, r.agrees) for r in tb.partition_migrate(source.mapInArrow(count, source.schema), store, side, "one").collect()}
    n = legacy.count()
    assert seen.value == n + 4 and out["bad"] == (4, 4, True) and sum(v[0] for v in out.values()) == n + 4
    kept = tb.scan_quarantine(spark, side, source.schema).collect()
    assert sorted(str(r.race_date) for r in kept) == ["+12345-01-01", "20x1-02-30", "20x1-02-30", "None"] and {r.extra for r in kept} == {"x"}
    assert tb.scan_partitions(spark, store).count() == n
    same = {r.month: (r.n_in, r.n_out, r.agrees) for r in tb.partition_migrate(source, store, side, "one").collect()}
    assert tb.partition_migrate(source, store, side, "one").count() == len(same) and same == out
    assert tb.partition_migrate(source.limit(0), store, side, "one").count() == 0 and tb.scan_partitions(spark, store).count() == 0
    assert tb.scan_quarantine(spark, side, source.schema).count() == 0
