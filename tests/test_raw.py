"""Page and message parsing, text cleaning, streams."""

import datetime as dt
import unicodedata

from pyspark.sql import functions as F

from paceline.functions import text as tx
from paceline.functions.hashing import hash_rows
from paceline.session import scratch_path
from paceline.sources import raw
from paceline.streaming import capture as cs


def one(spark, col, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(col(F.col("v"))).first()[0]


def test_text_cleaning(spark):
    clean = lambda v: one(spark, tx.clean_text, v)
    assert (clean("  Ａ１　b "), clean(""), clean("null"), clean(None), clean("   ")) == ("A1 b", None, None, None, None)
    money = lambda v: one(spark, tx.money, v)
    assert (money("8,460"), money("(3)"), money("-"), money("【未発売】"), money("x")) == (8460, 3, None, None, None)
    assert (one(spark, tx.clean_int, " 7 "), one(spark, tx.clean_int, "x"), one(spark, tx.clean_double, "１．５")) == (7, None, 1.5)
    assert [one(spark, tx.truthy, v) for v in ("True", "1", "false", None)] == [True, True, False, False]


def test_combination_text(spark):
    df = spark.createDataFrame([("0201", "ST2"), ("0201", "SH2"), ("030201", "RT3"), ("030201", "RH3")], "r string, b string")
    assert [r[0] for r in df.select(tx.format_combo(F.col("r"), F.col("b"))).collect()] == ["2-1", "1=2", "3-2-1", "1=2=3"]
    assert one(spark, lambda c: tx.car_at(c, 2), "4-x") is None and one(spark, lambda c: tx.car_at(c, 2), "4=7") == 7
    rid = spark.sql("select date'2026-09-04' d").select(tx.race_id(F.col("d"), F.lit(7), F.lit(12)))
    assert rid.first()[0] == "202609040712"


def test_json_block(spark):
    pages = ["a jsonData['K'] = {\"x\": 1}; b", 'jsonData["K"]={\n"x": {"y": 2}};', "jsonData['K'] = {broken};", "none", None]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    assert [r[0] for r in df.select(raw.json_block(F.col("html"), "K")).collect()] == ['{"x": 1}', '{\n"x": {"y": 2}}', None, None, None]


def page(spark, key, body):
    return spark.createDataFrame([("2026-01-01", 11, 3, f"<x>jsonData['{key}'] = {body};</x>")], "race_date string, place_code int, race_no long, html string")


def test_cancelled_needs_flag_and_no_race(spark):
    for flag, count, want in (("true", "0", True), ("true", "5", False), ("false", "0", False), ("true", "null", True)):
        df = page(spark, "PC0201", '{"C0201data": {"imgGradeAlt": "F1", "flgRaceCancel": %s, "cntRace": %s}}' % (flag, count))
        assert raw.to_meta(df).first()["is_canceled"] is want


def test_results_take_the_first_incident_that_is_not_blank(spark):
    body = ('{"tenki": "晴", "tyakujyunItemSubData": [{"tyaku": "1", "syaban": "4"}, {"tyaku": "", "syaban": "5", "kojinStateItemSubData": '
            '[{"kojinState": " ", "tyakuNote": "no"}, {"kojinState": "失格", "tyakuNote": "押圧"}, {"kojinState": "落車"}]}]}')
    rows = {r["car_no"]: (r["tyaku"], r["kojin_state"], r["tyaku_note"]) for r in raw.to_results(page(spark, "JSJ012", body)).collect()}
    assert rows == {4: (1, None, None), 5: (None, "失格", "押圧")}


def test_payouts_skip_unsold_and_hidden(spark):
    item = '{"kumiBan": "%s", "haraiGaku": "%s", "ninki": "(3)", "kumiDispFlg": %s}'
    body = '{"haraiGakuSubData": {"SH2HaraiGakuDispItemSubData": [%s, %s, %s], "WHaraiGakuDispItemSubData": [%s]}}' % (
        item % ("1=2", "8,460", "true"), item % ("1=3", "-", "true"), item % ("1=4", "500", "false"), item % ("2=3", "【未発売】", "true"))
    rows = raw.to_payouts(page(spark, "JSJ012", body)).collect()
    assert [(r["bet_type"], r["bet_name"], r["kumi_ban"], r["payout"], r["popularity"]) for r in rows] == [("SH2", "二車複", "1=2", 8460, 3)]


def test_price_lists(spark):
    text = ('{"official_dt": "2026-01-01 10:00:00", "list_6": [["0201", "12.3", "0.0", "4"], ["0102", "0", "0", "1"], ["0103"], ["0104", "x", "", ""]], '
            '"list_7": [["0201", "1.5", "2.5", "1"]]}')
    df = spark.createDataFrame([("2026-01-01", 1, 1, text)], "race_date string, place_code int, race_no long, odds_json string")
    rows = sorted((r["bet_type"], r["kumi_ban"], r["odds"], r["max_odds"], r["popularity"]) for r in raw.to_odds(df).collect())
    assert rows == [("ST2", "2-1", 12.3, None, 4), ("W", "1=2", 1.5, 2.5, 1)]


def test_digest_ignores_row_order(spark):
    rows = [(g, i) for g in range(3) for i in range(50)]
    digest = lambda r: {x["g"]: x["digest"] for x in hash_rows(spark.createDataFrame(r, "g int, i int"), ["g"], F.col("i").cast("string")).collect()}
    a, b = digest(rows), digest(rows[::-1])
    assert a == b and len({*a.values()}) == 1 and digest(rows + [(0, 1)])[0] != a[0] and all(len(v) == 12 for v in a.values())


def feed(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in.parquet")
    return spark.readStream.schema(spark.read.parquet(f"{folder}/in.parquet").schema).parquet(f"{folder}/in.parquet")


def test_repeated_captures_are_dropped_across_batches(spark):
    folder, out, state = scratch_path(spark, "feed"), scratch_path(spark, "out"), scratch_path(spark, "state")
    schema = "race_date string, place_code int, race_no long, target_offset_min double, event_time timestamp"
    at = lambda m: dt.datetime(2026, 1, 1, 10, m)
    for minute in (0, 1):
        src = feed(spark, folder, [("2026-01-01", 1, n, 1.0, at(minute)) for n in (1, 2 + minute)], schema)
        q = cs.to_files(cs.dedup_captures(src), out).option("checkpointLocation", state).trigger(availableNow=True).start()
        q.awaitTermination()
    assert sorted(r["race_no"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_overround_window_waits_for_the_watermark(spark):
    folder, out = scratch_path(spark, "feed"), scratch_path(spark, "out")
    schema = "race_date string, place_code int, race_no long, odds double, event_time timestamp"
    at = lambda m, s: dt.datetime(2026, 1, 1, 10, m, s)
    src = feed(spark, folder, [("2026-01-01", 1, 1, 2.0, at(0, 1)), ("2026-01-01", 1, 1, 4.0, at(0, 59)), ("2026-01-01", 1, 1, 5.0, at(9, 0))], schema)
    cs.run_available(cs.to_files(cs.overround_windows(src), out), spark)
    assert [(r["overround"], r["n"]) for r in spark.read.parquet(out).collect()] == [(0.75, 2)]


def test_nfkc_of_every_character_of_the_plane(spark):
    chars = [(c, chr(c)) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    got = spark.createDataFrame(chars, "code int, s string").select("code", tx.nfkc(F.col("s")).alias("t")).collect()
    assert [hex(r["code"]) for r in got if r["t"] != unicodedata.normalize("NFKC", chr(r["code"]))] == []


def test_nfkc_of_texts(spark):
    texts = ["", "plain", "ﾎﾟｯｷｰ ｶﾞ", "①㈱Ａ１　Ｂ", "e\u0301a\u0302\u0301", "か\u3099は\u309a", "㌔ﬁ½", "\u0301x", "競輪", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "s string").select(tx.nfkc(F.col("s"))).collect()]
    assert got == [t if t is None else unicodedata.normalize("NFKC", t) for t in texts]


def test_late_captures_are_parted_over_several_batches(spark, tmp_path):
    schema = "id long, seconds_before_start double"
    for rows in ([(1, 5.0), (2, -1.0)], [(3, None), (4, -0.5)], [(5, 0.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "feed"))
    out = str(tmp_path / "sides")
    cs.run_available(cs.split_late(feed, out), spark)
    got = spark.read.parquet(out)
    assert got.select("batch").distinct().count() == 3
    assert {(r["id"], r["side"]) for r in got.collect()} == {(1, "main"), (2, "late"), (3, "main"), (4, "late"), (5, "main")}
