"""Raw captures built from the driver tables, and the operators that read them back (2.1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paceline.functions.text import car_numbers
from paceline.keys import CAR, COMBO, RACE, VENUE_DAY
from paceline.operators.dedup import dedup_latest
from paceline.plans import bindings as b
from paceline.plans.registry import query
from paceline.sources import raw

R = "race_date, place_code, race_no"


def _script(key: str, value: Column, quote: str = "'") -> Column:
    return F.concat(F.lit(f"<script>jsonData[{quote}{key}{quote}] = "), F.to_json(value), F.lit(";</script>"))


def _s(col: str, name: str) -> Column:
    return F.col(col).cast("string").alias(name)


def race_pages(spark, sf) -> DataFrame:
    """One page per race (at most nine riders) with its card, records and result blocks."""
    r = b.runners(spark, sf).join(b.narabi(spark, sf), CAR).join(b.results(spark, sf), CAR, "left")
    rider = F.struct(_s("car_no", "syaban"), _s("player_code", "senNo"), F.lit(" ").alias("senName"), _s("prefecture", "huken"),
                     _s("kyaku", "kyaku"), F.lit("null").alias("Yosoin"))
    place = F.struct(_s("car_no", "syaban"), _s("narabi_x", "narabiX"), _s("narabi_y", "narabiY"))
    stat = F.struct(_s("car_no", "syaban"), _s("kyuhan", "kyuhan"), _s("age", "age"), _s("syouritu", "syouritu"), _s("nige_cnt", "nigeCnt"))
    incident = F.array(F.struct(F.lit("").alias("kojinState"), F.lit("x").alias("tyakuNote")),
                       F.struct(F.lit("失格").alias("kojinState"), F.lit("押圧").alias("tyakuNote")))
    finish = F.struct(_s("tyaku", "tyaku"), _s("car_no", "syaban"), F.when(F.col("tyaku").isNull(), incident).alias("kojinStateItemSubData"))
    lists = lambda x: F.sort_array(F.collect_list(x))
    pages = r.groupBy(*RACE).agg(
        F.min("st_time").alias("st_time"), F.min("status").alias("status"), lists(rider).alias("s"), lists(place).alias("n"), lists(stat).alias("t"),
        F.collect_list(finish).alias("f"))
    card = F.struct(F.array(F.struct(_s("race_no", "raceNo"), F.col("st_time").alias("stTime"), F.col("s").alias("sInfo"), F.col("n").alias("nInfo"))).alias("rInfo"))
    stats = F.struct(F.array(F.struct(_s("race_no", "raceNo"), F.col("t").alias("sensyuTypeInfo"))).alias("raceInfo"))
    done = F.struct(F.lit("晴").alias("tenki"), F.col("f").alias("tyakujyunItemSubData"))
    html = F.concat(F.lit("<html><body>"), _script("PJ0305", card), _script("JSJ002", stats, '"'),
                    F.when(F.col("status") != "P", _script("JSJ012", done)).otherwise(F.lit("<script>jsonData['JSJ012'] = {broken};</script>")),
                    F.lit("</body></html>"))
    return pages.select(*RACE, html.alias("html"))


def payout_pages(spark, sf) -> DataFrame:
    """One result page per race with its winners (a handful); one ticket of each race is unsold."""
    item = F.struct(F.col("kumi_ban").alias("kumiBan"), F.format_number("payout", 0).alias("haraiGaku"),
                    F.concat(F.lit("("), F.length("kumi_ban"), F.lit(")")).alias("ninki"), F.lit(True).alias("kumiDispFlg"))
    unsold = F.struct(F.lit("1=2").alias("kumiBan"), F.lit("【未発売】").alias("haraiGaku"), F.lit("").alias("ninki"), F.lit(True).alias("kumiDispFlg"))
    bets = ["SH2", "ST2", "RH3", "RT3", "W"]
    pays = b.payouts(spark, sf).groupBy(*RACE).agg(*[
        F.collect_list(F.when(F.col("bet_type") == x, item)).alias(f"{x}HaraiGakuDispItemSubData") for x in bets])
    block = F.struct(F.struct(F.array(unsold).alias("WH2HaraiGakuDispItemSubData"),
                              *[F.col(f"{x}HaraiGakuDispItemSubData") for x in bets]).alias("haraiGakuSubData"))
    return pays.select(*RACE, _script("JSJ012", block).alias("html"))


def meta_pages(spark, sf) -> DataFrame:
    off = F.col("is_canceled") == "True"
    data = F.struct(F.struct(F.col("grade").alias("imgGradeAlt"), F.date_format("race_date", "yyyyMMdd").alias("selKaisai"),
                             off.alias("flgRaceCancel"), F.when(~off, 12).alias("cntRace")).alias("C0201data"))
    return b.meta(spark, sf).select(*VENUE_DAY, _script("PC0201", data).alias("html"))


def price_messages(spark, sf) -> DataFrame:
    """One message per race: ST2, SH2, W, RH3 and RT3 lists of [cars, price, upper price, popularity]."""
    odds = dedup_latest(b.snapshots(spark, sf), b.SNAP_TIES)
    cars = F.array_join(F.transform(car_numbers(F.col("kumi_ban")), lambda x: F.lpad(x.cast("string"), 2, "0")), "")
    item = F.array(cars, F.col("odds").cast("string"), F.coalesce(F.col("max_odds").cast("string"), F.lit("0.0")), F.col("popularity").cast("string"))
    lists = {k: bet for k, bet in raw.PRICE_LISTS.items() if bet in ("ST2", "SH2", "W", "RH3", "RT3")}
    per_race = odds.groupBy(*RACE).agg(*[F.collect_list(F.when(F.col("bet_type") == bet, item)).alias(k) for k, bet in lists.items()])
    zero = F.array(F.lit("0102"), F.lit("0"), F.lit("0"), F.lit("1"))
    return per_race.select(*RACE, F.to_json(F.struct(F.lit("2001-01-01 00:00:00").alias("official_dt"), F.array(zero).alias("list_3"), *lists)).alias("odds_json"))


@query("raw_json_extract", f"SELECT {R}, bool_or(status <> 'P') AS has_results, true AS has_card FROM runners GROUP BY ALL", dt="race_date")
def _(spark, sf):
    return race_pages(spark, sf).select(*RACE, raw.json_block(F.col("html"), "JSJ012").isNotNull().alias("has_results"),
                                        raw.json_block(F.col("html"), "PJ0305").isNotNull().alias("has_card"))


@query("json_extract", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def _(spark, sf):
    return b.table(spark, sf, "events").select("event_id", F.from_json("props", "struct<k: int>").getField("k").alias("k"))


@query("page_script_extract", "SELECT page_id, TRY_CAST(nullif(regexp_extract(html, 'track\\((\\d+)\\)', 1), '') AS INT) AS tracked FROM pages")
def _(spark, sf):
    return b.table(spark, sf, "pages").select("page_id", F.regexp_extract("html", r"track\((\d+)\)", 1).try_cast("int").alias("tracked"))


@query("raw_to_meta", "SELECT race_date, place_code, grade, strftime(race_date, '%Y%m%d') AS sel_kaisai, is_canceled = 'True' AS is_canceled FROM meta", dt="race_date")
def _(spark, sf):
    return raw.to_meta(meta_pages(spark, sf)).select(*VENUE_DAY, "grade", "sel_kaisai", "is_canceled")


@query("raw_to_entries", f"""SELECT {R}, car_no, CAST(player_code AS VARCHAR) AS player_code, CAST(NULL AS VARCHAR) AS player_name, prefecture, kyaku,
  CAST(NULL AS VARCHAR) AS yosoin, st_time FROM runners""", dt="race_date")
def _(spark, sf):
    return raw.to_entries(race_pages(spark, sf)).select(*CAR, "player_code", "player_name", "prefecture", "kyaku", "yosoin", "st_time")


@query("raw_to_lines", f"SELECT {R}, car_no, narabi_x, narabi_y FROM narabi", dt="race_date")
def _(spark, sf):
    return raw.to_lines(race_pages(spark, sf))


@query("raw_to_stats", f"SELECT {R}, car_no, kyuhan, age, syouritu, nige_cnt FROM runners", dbl="syouritu", dt="race_date")
def _(spark, sf):
    return raw.to_stats(race_pages(spark, sf)).select(*CAR, "kyuhan", "age", "syouritu", "nige_cnt")


@query("raw_to_results", f"""SELECT {R}, car_no, tyaku, CASE WHEN tyaku IS NULL THEN '失格' END AS kojin_state, CASE WHEN tyaku IS NULL THEN '押圧' END AS tyaku_note,
  '晴' AS tenki FROM results""", dt="race_date")
def _(spark, sf):
    return raw.to_results(race_pages(spark, sf)).select(*CAR, "tyaku", "kojin_state", "tyaku_note", "tenki")


BET_NAME_SQL = "CASE bet_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in raw.BET_NAMES.items()) + " END"


@query("raw_to_payouts", f"SELECT {R}, bet_type, {BET_NAME_SQL} AS bet_name, kumi_ban, payout, CAST(length(kumi_ban) AS INT) AS popularity FROM payouts", dt="race_date")
def _(spark, sf):
    return raw.to_payouts(payout_pages(spark, sf))


@query("raw_to_odds", f"""SELECT {R}, bet_type, kumi_ban, odds, max_odds, popularity, '2001-01-01 00:00:00' AS official_dt FROM latest_odds""", dbl="odds max_odds", dt="race_date")
def _(spark, sf):
    return raw.to_odds(price_messages(spark, sf)).select(*COMBO, "odds", "max_odds", "popularity", "official_dt")
