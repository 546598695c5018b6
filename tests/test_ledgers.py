"""Completion, voids, quality, plans and daily health (fixtures F3, F4, F9, F10, F11)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paceline.functions.moments import report_window, start_ts
from paceline.operators import aggregates as ag, joins as jo, quality as qa
from paceline.sources.tables import refresh_window
from paceline.streaming import capture as cs

RACE = "race_date date, place_code int, race_no long"
CAR = f"{RACE}, car_no int"


def completion(frame, entries, results, payouts, meta=(), voids=()):
    return qa.completion_race(
        frame(CAR, entries), frame(f"{CAR}, tyaku int", results), frame(f"{RACE}, bet_type string, kumi_ban string", payouts),
        frame("race_date date, place_code int, is_canceled string", meta), frame(f"{RACE}, reason string", voids))


def statuses(df):
    return {(str(r["race_date"]), r["place_code"], r["race_no"]): (r["status"], r["void_reason"]) for r in df.collect()}


def test_completion_and_refresh(frame):
    entries = [(d, 11, 1, c) for d in ("2026-11-01", "2026-11-02") for c in (1, 2)]
    day1 = [("2026-11-01", 11, 1, 1, 1), ("2026-11-01", 11, 1, 2, 2)]
    pay1 = [("2026-11-01", 11, 1, "ST2", "1-2")]
    before = completion(frame, entries, day1, pay1)
    assert statuses(before) == {("2026-11-01", 11, 1): ("complete", ""), ("2026-11-02", 11, 1): ("missing_results", "")}
    day2 = day1 + [("2026-11-02", 11, 1, 1, 1), ("2026-11-02", 11, 1, 2, 2)]
    after = completion(frame, entries, day2, pay1 + [("2026-11-02", 11, 1, "ST2", "1-2")])
    marked = before.withColumn("void_reason", F.when(F.col("race_date") < "2026-11-02", "old").otherwise(""))
    out = statuses(refresh_window(marked, after, "2026-11-03", 1))
    assert out == {("2026-11-01", 11, 1): ("complete", "old"), ("2026-11-02", 11, 1): ("complete", "")}


def test_cancelled_races_and_sources_without_entries(frame):
    out = statuses(completion(
        frame, [("2026-11-01", 11, 1, 1), ("2026-11-01", 12, 1, 1)],
        [("2026-11-01", 11, 1, 1, None), ("2026-11-01", 11, 2, 1, 1)], [],
        meta=[("2026-11-01", 12, "1"), ("2026-11-01", 11, "False")]))
    assert out == {("2026-11-01", 11, 1): ("canceled", ""), ("2026-11-01", 11, 2): ("missing_payout", ""), ("2026-11-01", 12, 1): ("canceled", "")}


def test_voids_explain_missing_races_only(frame):
    entries = [("2026-11-10", 11, n, 1) for n in (1, 2, 3)] + [("2026-11-10", 12, n, 1) for n in (1, 2)]
    out = statuses(completion(
        frame, entries, [("2026-11-10", 11, 2, 1, 1)], [("2026-11-10", 11, 2, "ST2", "1-2")],
        voids=[("2026-11-10", 11, 1, "full_refund"), ("2026-11-10", 12, None, "day_canceled"), ("2026-11-10", 11, 2, "full_refund")]))
    day = "2026-11-10"
    assert out == {(day, 11, 1): ("canceled", "full_refund"), (day, 11, 2): ("complete", ""), (day, 11, 3): ("missing_results", ""),
                   (day, 12, 1): ("canceled", "day_canceled"), (day, 12, 2): ("canceled", "day_canceled")}


def test_results_missing_needs_two_venues(frame):
    q = frame("race_date date, place_code int, n_planned long, n_results long, is_canceled boolean, status string",
              [("2026-01-01", p, 12, 0, False, "all_canceled") for p in (1, 2, 3)] + [("2026-01-02", 1, 12, 0, False, "all_canceled"), ("2026-01-02", 2, 12, 12, False, "normal")])
    out = {(str(r["race_date"]), r["place_code"]): r["status"] for r in qa.mark_results_missing(q).collect()}
    assert {out["2026-01-01", p] for p in (1, 2, 3)} == {"results_missing"} and out["2026-01-02", 1] == "all_canceled"


def test_quality_precedence(frame):
    meta = frame("race_date date, place_code int, is_canceled string", [("2026-01-01", p, "true" if p == 1 else "") for p in range(1, 7)])
    races = lambda spec: frame(CAR, [("2026-01-01", p, n, 1) for p, k in spec.items() for n in range(k)])
    out = qa.quality_venue_day(meta, races({1: 2, 3: 2, 4: 2, 5: 2, 6: 3}), races({4: 1, 5: 2, 6: 3}), races({5: 1, 6: 3})).collect()
    got = {r["place_code"]: (r["status"], r["completion"]) for r in out}
    assert got == {1: ("canceled", 0.0), 2: ("no_entries", 0.0), 3: ("all_canceled", 0.0), 4: ("partial_canceled", 0.0),
                   5: ("payout_missing", 0.5), 6: ("normal", 1.0)}


def test_lineup_gaps_by_band(frame):
    entries, lines = [], []
    for d in ("2026-11-01", "2026-11-02"):
        entries += [(d, 42, 1, 1, "21:00"), (d, 42, 2, 1, "22:00"), (d, 27, 1, 1, "11:00"), (d, 27, 2, 1, "12:00")]
        lines += [(d, 27, 1, 1), (d, 27, 2, 1)]
    bands = qa.lines_gap_by_band(frame(f"{CAR}, st_time string", entries), frame(CAR, lines), "2026-11-01", "2026-11-02")
    got = {r["band"]: (r["races"], r["missing_races"], r["venue_days"], r["missing_venue_days"]) for r in bands.collect()}
    assert got == {"midnight": (4, 4, 2, 2), "day": (4, 0, 2, 0)}
    flag = qa.lineup_gap_flag(bands).first()
    assert flag["rate"] == 0.5 and flag["flag"] == "warn"


def test_backfill_plan(frame):
    meta = frame("race_date date, place_code int", [(f"2026-11-{d:02d}", 11) for d in (4, 5, 6, 7, 8, 9)])
    comp = frame("race_date date, place_code int, status string",
                 [("2026-11-05", 11, "missing_results"), ("2026-11-06", 13, "missing_payout"), ("2026-11-07", 11, "complete")])
    plan = {(str(r["race_date"]), r["place_code"]) for r in jo.backfill_plan(meta, comp, "2026-11-10", 7, "2026-11-09").collect()}
    assert plan == {("2026-11-03", None), ("2026-11-05", 11), ("2026-11-06", 13)}


def at(day, hm):
    return dt.datetime.fromisoformat(f"{day} {hm}:00")


@pytest.mark.parametrize("starts,want", [
    (["20:50"], ["18:50", "19:50", "20:20", "20:40"]), (["08:30"], ["08:00", "08:20"]), (["07:00"], []), (["07:30", "09:00"], ["08:00", "08:30", "08:50"])])
def test_lineup_checks(spark, frame, starts, want):
    races = frame(f"{RACE}, start_dt timestamp_ntz", [("2026-11-20", 42, i, at("2026-11-20", s)) for i, s in enumerate(starts)])
    now = F.lit("2026-11-20 08:00:00").cast("timestamp_ntz")
    rows = cs.plan_lineup_checks(races, frame(RACE, []), now).orderBy("due").collect()
    assert [f"{r['due']:%H:%M}" for r in rows] == want
    assert [r["last"] for r in rows] == [False] * (len(want) - 1) + [True] * bool(want)


def test_capture_plan_drops_logged_and_late(spark, frame):
    races = frame(f"{RACE}, start_dt timestamp_ntz", [("2026-11-20", 42, 1, at("2026-11-20", "10:00"))])
    log = frame(f"{RACE}, target_offset_min double", [("2026-11-20", 42, 1, 1.0)])
    now = F.lit("2026-11-20 09:58:30").cast("timestamp_ntz")
    got = {r["target_offset_min"] for r in cs.plan_captures(races, log, now).collect()}
    assert got == {3.0, 2.0, 0.5}


def test_reschedule_moves_and_drops(frame):
    planned = frame(f"{RACE}, target_offset_min double, start_dt timestamp_ntz", [("2026-11-20", 1, n, 1.0, at("2026-11-20", "10:00")) for n in (1, 2, 3)])
    program = frame(f"{RACE}, start_dt timestamp_ntz", [("2026-11-20", 1, 1, at("2026-11-20", "10:10")), ("2026-11-20", 1, 2, at("2026-11-20", "10:00"))])
    got = {r["race_no"]: (r["action"], r["due"]) for r in cs.reschedule(planned, program).collect()}
    assert got[1] == ("moved", at("2026-11-20", "10:09")) and got[2][0] == "kept" and got[3] == ("dropped", None)


def test_capture_timing_from_times(frame):
    log = frame(f"{RACE}, start_dt timestamp_ntz, snapshot_dt timestamp_ntz, target_offset_min double",
                [("2026-11-20", 1, 1, at("2026-11-20", "10:00"), dt.datetime(2026, 11, 20, 9, 59, 3), 1.0)])
    r = qa.log_backfill_seconds(log).first()
    assert (r["lag"], r["before_start"]) == (3.0, 57.0)


def daily(frame, n_lines, n_snaps, n_results=10, date="2026-11-01"):
    rows = lambda n: frame(CAR, [(date, 1, i % 2, i) for i in range(n)])
    log = frame(f"{RACE}, status string", [(date, 1, 1, "ok")] * n_snaps)
    return qa.daily_health({"entries": rows(100), "lines": rows(n_lines), "results": rows(n_results)}, log, date, "2026-11-02", "2026-11-05").orderBy("race_date").collect()


@pytest.mark.parametrize("lines,snaps,status", [(100, 10, "ok"), (77, 10, "ok_with_note"), (40, 10, "lines_warn"), (100, 6, "snapshots_warn"),
                                                (0, 10, "lines_missing"), (100, 0, "snapshots_missing")])
def test_daily_coverage(frame, lines, snaps, status):
    days = daily(frame, lines, snaps)
    assert [d["status"] for d in days] == [status, "no_data"]


def test_overall_status_ignores_today(frame):
    d = frame("race_date date, status string", [("2026-11-01", "ok"), ("2026-11-02", "ok_with_note"), ("2026-11-03", "in_progress")])
    none, one = frame(RACE, []), frame(RACE, [("2026-11-01", 1, 1)])
    assert qa.overall_status(d, none).first().asDict() == {"n_total_days": 2, "n_ok_days": 2, "n_nodata": 0, "n_warn": 0, "n_missing": 0, "level": "OK"}
    assert qa.overall_status(d, one).first()["level"] == "WARN"
    bad = d.unionByName(frame("race_date date, status string", [("2026-11-04", "no_data")]))
    assert qa.overall_status(bad, none).first()["level"] == "NG"


def test_first_start_of_the_day(frame):
    e = frame("race_date date, st_time string", [("2026-11-01", s) for s in ("15:30", "10:45:00", "", "bogus")] + [("2026-11-02", "08:00")])
    first = e.withColumn("s", start_ts(F.col("race_date"), F.col("st_time"))).groupBy("race_date").agg(F.min("s").alias("s"))
    assert {str(r["race_date"]): str(r["s"]) for r in first.collect()}["2026-11-01"] == "2026-11-01 10:45:00"


def test_recovery_outcomes(frame):
    missing = frame(f"{RACE}, prev_status string", [("2026-01-01", 1, n, s) for n, s in ((1, "missing_results"), (2, "missing_results"), (3, "missing_results"), (4, "missing_payout"))]
                    + [("2026-01-02", 1, 1, "missing_payout")])
    results = frame(f"{CAR}, tyaku int", [("2026-01-01", 1, 1, 1, 1), ("2026-01-01", 1, 2, 1, None)])
    out = qa.recovery_classify(missing, results, frame(RACE, [("2026-01-01", 1, 4)]), frame(RACE, [("2026-01-01", 1, 1)]), frame("race_date date, place_code int", [("2026-01-02", 1)]))
    got = {(str(r["race_date"]), r["race_no"]): (r["outcome"], r["is_side_effect"]) for r in out.collect()}
    assert got == {("2026-01-01", 1): ("recovered", 0), ("2026-01-01", 2): ("canceled_confirmed", 1), ("2026-01-01", 3): ("still_missing", 1),
                   ("2026-01-01", 4): ("recovered", 1), ("2026-01-02", 1): ("parse_error", 1)}


def test_report_window_and_status_counts(frame):
    assert report_window("2026-11-08", days=7) == ("2026-11-01", "2026-11-08") and report_window("2026-11-08", since="2026-10-01")[0] == "2026-10-01"
    log = frame("target_offset_min string, status string", [("5.0", "ok"), (None, "fail"), ("0.5", "ok")])
    got = {r["target_offset_min"]: (r["n_ok"], r["n_fail"]) for r in ag.status_counts(log).collect()}
    assert got == {5.0: (1, 1), 0.5: (1, 0)}


def test_keyed_insert_keeps_the_reason_named_first(spark):
    from paceline.sources.tables import keyed_insert

    schema = "k int, reason string"
    rows = spark.createDataFrame([(1, "late"), (1, "void"), (2, "late"), (3, "other"), (None, "late"), (None, "void")], schema)
    got = keyed_insert(spark.createDataFrame([(2, "void")], schema), rows, ["k"], ["void", "late"])
    assert sorted(((r.k, r.reason) for r in got.collect()), key=str) == [(1, "void"), (2, "void"), (None, "void")]


def test_clean_text_strips_wide_padding(spark):
    from paceline.functions.text import clean_text
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("　青森　",), ("　",), (" null",), ("null",), ("Ａ　Ｂ",), (None,)], "t string")
    assert [r.c for r in df.select(clean_text(F.col("t")).alias("c")).collect()] == ["青森", None, "null", None, "A B", None]


def test_race_losses_do_not_underflow(spark):
    from paceline.operators.models import race_nll
    from pyspark.sql import functions as F

    df = spark.createDataFrame([([(-2000.0, 0.0, 1.0), (-2001.0, 0.0, 0.0)],)], "cars array<struct<q double, m double, y double>>")
    got = df.select(race_nll(F.lit(1.0), F.lit(0.0)).alias("l")).first().l
    assert abs(got - 0.3132616875) < 1e-9


def test_reschedule_keeps_blank_starts_and_drops_run_races(frame):
    from paceline.streaming import capture as cs

    key = "race_date date, place_code int, race_no int"
    planned = frame(f"{key}, target_offset_min double, start_dt string", [("2024-01-01", 1, n, 5.0, "2024-01-01 10:00:00") for n in (1, 2, 3, 4)])
    planned = planned.withColumn("start_dt", planned.start_dt.cast("timestamp"))
    program = frame(f"{key}, start_dt string, has_result boolean", [
        ("2024-01-01", 1, 1, None, None), ("2024-01-01", 1, 2, "2024-01-01 10:00:00", True), ("2024-01-01", 1, 3, "2024-01-01 10:30:00", False)])
    program = program.withColumn("start_dt", program.start_dt.cast("timestamp"))
    got = {r.race_no: (r.action, str(r.due)) for r in cs.reschedule(planned, program).collect()}
    assert got == {1: ("kept", "2024-01-01 09:55:00"), 2: ("dropped", "None"), 3: ("moved", "2024-01-01 10:25:00"), 4: ("dropped", "None")}
