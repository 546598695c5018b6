"""Raw page captures and price messages to table rows (2.1).

Every function takes a table of captures (one page or message per row) and works on it with
``regexp_extract``, ``from_json`` and ``explode``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paceline.functions.text import UNSOLD, clean_double, clean_int, clean_text, format_combo, money
from paceline.keys import BET_TYPES

# Field names of the pages and messages.
_ENTRY = "syaban senNo senName huken kyaku Yosoin itiosiFlag aisyoFlag assen"
_ENTRY_RACE = "raceNo syumoku denTime stTime line narabiFlg ozzFlg resultFlg"
_STAT = ("syaban sensyuRegistNo sensyuName huKen kyuhan prevKyuhan kyakusitu sotugyouki age heikinTokuten nigeCnt makuriCnt sasiCnt markCnt "
         "backCnt homeTori stTori syouritu rentairitu2 rentairitu3 ketujyouTuikaHojyu")
_STAT_RACE = "raceNo shumokuName kyori shukai kyosoShurui yudoSensyuName"
_RESULT = "tyaku syaban sensyuRegistNo sensyuName age huken sotugyouki kyuhan tyakusa agari kimarite BH inLineJyuni"
_META = "joName raceName imgGradeAlt selKaisai encSelParaK encParaS"
PRICE_LISTS = {"list_3": "WH2", "list_4": "WT2", "list_5": "SH2", "list_6": "ST2", "list_7": "W", "list_8": "RH3", "list_9": "RT3"}


def _struct(names: str, *more: str) -> str:
    return "struct<" + ", ".join([f"{n}: string" for n in names.split()] + list(more)) + ">"


ENTRIES_SCHEMA = f"struct<rInfo: array<{_struct(_ENTRY_RACE, f'sInfo: array<{_struct(_ENTRY)}>', f'nInfo: array<{_struct('syaban narabiX narabiY')}>')}>>"
STATS_SCHEMA = f"struct<raceInfo: array<{_struct(_STAT_RACE, f'sensyuTypeInfo: array<{_struct(_STAT)}>')}>>"
_STATES = f"kojinStateItemSubData: array<{_struct('kojinState tyakuNote')}>"
_PAID = ", ".join(f"{b}HaraiGakuDispItemSubData: array<{_struct('kumiBan haraiGaku ninki', 'kumiDispFlg: boolean')}>" for b in BET_TYPES)
RESULTS_SCHEMA = f"struct<tenki: string, husoku: string, tyakujyunItemSubData: array<{_struct(_RESULT, _STATES)}>, haraiGakuSubData: struct<{_PAID}>>"
META_SCHEMA = f"struct<C0201data: {_struct(_META, 'flgRaceCancel: boolean', 'cntRace: int')}>"
PRICES_SCHEMA = "struct<official_dt: string, " + ", ".join(f"{k}: array<array<string>>" for k in PRICE_LISTS) + ">"


def json_block(html: Column, key: str) -> Column:
    """The object assigned to ``jsonData['KEY']`` in a page; NULL if absent or not valid JSON."""
    text = F.regexp_extract(html, rf"(?s)jsonData\[['\"]{key}['\"]\]\s*=\s*(\{{.*?\}});", 1)
    return F.when(F.call_function("try_parse_json", F.nullif(text, F.lit(""))).isNotNull(), text)


def _pages(captures: DataFrame, key: str, schema: str, *keep: str) -> DataFrame:
    return captures.select(*keep, F.from_json(json_block(F.col("html"), key), schema).alias("d")).where(F.col("d").isNotNull())


def to_meta(captures: DataFrame) -> DataFrame:
    """Venue-day data; cancelled = the flag is set and no race is counted."""
    d = _pages(captures, "PC0201", META_SCHEMA, "race_date", "place_code").select("race_date", "place_code", "d.C0201data.*")
    off = F.coalesce("flgRaceCancel", F.lit(False)) & (F.coalesce("cntRace", F.lit(0)) == 0)
    names = zip(_META.split(), ["place_name", "race_name", "grade", "sel_kaisai", "enc_para_k", "enc_para_s"], strict=True)
    return d.select("race_date", "place_code", *[clean_text(F.col(a)).alias(n) for a, n in names], off.alias("is_canceled"))


def _races(captures: DataFrame) -> DataFrame:
    pages = _pages(captures, "PJ0305", ENTRIES_SCHEMA, "race_date", "place_code")
    return pages.select("race_date", "place_code", F.explode("d.rInfo").alias("r"))


def to_entries(captures: DataFrame) -> DataFrame:
    rows = _races(captures).select("race_date", "place_code", "r", F.explode("r.sInfo").alias("p"))
    text = lambda c, n: clean_text(F.col(c)).alias(n)
    num = lambda c, n: clean_int(F.col(c)).alias(n)
    return rows.select(
        "race_date", "place_code", F.col("r.raceNo").try_cast("long").alias("race_no"), num("p.syaban", "car_no"),
        text("p.senNo", "player_code"), text("p.senName", "player_name"), text("p.huken", "prefecture"), text("p.kyaku", "kyaku"),
        text("p.Yosoin", "yosoin"), num("p.itiosiFlag", "itioshi_flag"), num("p.aisyoFlag", "aisyo_flag"), text("p.assen", "assen"),
        text("r.syumoku", "syumoku"), text("r.denTime", "den_time"), text("r.stTime", "st_time"), text("r.line", "line_type"),
        num("r.narabiFlg", "narabi_flg"), num("r.ozzFlg", "ozz_flg"), num("r.resultFlg", "result_flg"))


def to_lines(captures: DataFrame) -> DataFrame:
    rows = _races(captures).select("race_date", "place_code", "r", F.explode("r.nInfo").alias("n"))
    return rows.select(
        "race_date", "place_code", F.col("r.raceNo").try_cast("long").alias("race_no"), clean_int(F.col("n.syaban")).alias("car_no"),
        clean_int(F.col("n.narabiX")).alias("narabi_x"), clean_int(F.col("n.narabiY")).alias("narabi_y"))


def to_stats(captures: DataFrame) -> DataFrame:
    pages = _pages(captures, "JSJ002", STATS_SCHEMA, "race_date", "place_code")
    rows = pages.select("race_date", "place_code", F.explode("d.raceInfo").alias("r")).select(
        "race_date", "place_code", "r", F.explode("r.sensyuTypeInfo").alias("p"))
    text = lambda c, n: clean_text(F.col(c)).alias(n)
    num = lambda c, n: clean_int(F.col(c)).alias(n)
    real = lambda c, n: clean_double(F.col(c)).alias(n)
    return rows.select(
        "race_date", "place_code", F.col("r.raceNo").try_cast("long").alias("race_no"), num("p.syaban", "car_no"),
        text("p.sensyuRegistNo", "player_code"), text("p.sensyuName", "player_name"), text("p.huKen", "prefecture"),
        text("p.kyuhan", "kyuhan"), text("p.prevKyuhan", "prev_kyuhan"), text("p.kyakusitu", "kyakusitu"),
        num("p.sotugyouki", "sotugyouki"), num("p.age", "age"), real("p.heikinTokuten", "heikin_tokuten"),
        num("p.nigeCnt", "nige_cnt"), num("p.makuriCnt", "makuri_cnt"), num("p.sasiCnt", "sasi_cnt"), num("p.markCnt", "mark_cnt"),
        num("p.backCnt", "back_cnt"), num("p.homeTori", "home_tori"), num("p.stTori", "st_tori"), real("p.syouritu", "syouritu"),
        real("p.rentairitu2", "rentairitu2"), real("p.rentairitu3", "rentairitu3"), text("p.ketujyouTuikaHojyu", "ketujyou_tuika_hojyu"),
        text("r.shumokuName", "shumoku_name"), num("r.kyori", "kyori"), num("r.shukai", "shukai"), text("r.kyosoShurui", "kyoso_shurui"),
        text("r.yudoSensyuName", "yudo_sensyu"))


def _result_pages(captures: DataFrame) -> DataFrame:
    return _pages(captures, "JSJ012", RESULTS_SCHEMA, "race_date", "place_code", "race_no")


def to_results(captures: DataFrame) -> DataFrame:
    """Finishers; the first incident that is not blank gives the state and its note."""
    rows = _result_pages(captures).select("race_date", "place_code", "race_no", "d.tenki", "d.husoku", F.explode("d.tyakujyunItemSubData").alias("p"))
    states = F.filter(F.coalesce(F.col("p.kojinStateItemSubData"), F.array()), lambda s: clean_text(s["kojinState"]).isNotNull())
    first = F.get(states, F.lit(0))
    text = lambda c, n: clean_text(F.col(c)).alias(n)
    num = lambda c, n: clean_int(F.col(c)).alias(n)
    return rows.select(
        "race_date", "place_code", "race_no", num("p.tyaku", "tyaku"), num("p.syaban", "car_no"), text("p.sensyuRegistNo", "player_code"),
        text("p.sensyuName", "player_name"), num("p.age", "age"), text("p.huken", "prefecture"), num("p.sotugyouki", "sotugyouki"),
        text("p.kyuhan", "kyuhan"), text("p.tyakusa", "tyakusa"), clean_double(F.col("p.agari")).alias("agari"), text("p.kimarite", "kimarite"),
        text("p.BH", "bh"), text("p.inLineJyuni", "in_line_jyuni"), clean_text(first["kojinState"]).alias("kojin_state"),
        clean_text(first["tyakuNote"]).alias("tyaku_note"), text("tenki", "tenki"), text("husoku", "husoku"))


# The names under which tickets are sold.
BET_NAMES = {"WH2": "枠複", "WT2": "枠単", "SH2": "二車複", "ST2": "二車単", "RH3": "三連複", "RT3": "三連単", "W": "ワイド"}


def bet_name(bet_type: Column) -> Column:
    """The name of a bet type, NULL for an unknown one."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in BET_NAMES.items() for x in pair]), bet_type)


def to_payouts(captures: DataFrame) -> DataFrame:
    """Seven lists of winners to long rows; tickets that are not shown or were not sold are left out."""
    lists = F.array(*[
        F.struct(F.lit(b).alias("bet_type"), F.col(f"d.haraiGakuSubData.{b}HaraiGakuDispItemSubData").alias("items")) for b in BET_TYPES])
    rows = _result_pages(captures).select("race_date", "place_code", "race_no", F.inline(lists)).select(
        "race_date", "place_code", "race_no", "bet_type", F.explode("items").alias("i"))
    paid = clean_text(F.col("i.haraiGaku"))
    shown = rows.where(F.coalesce("i.kumiDispFlg", F.lit(False)) & paid.isNotNull() & ~paid.isin(UNSOLD))
    return shown.select("race_date", "place_code", "race_no", "bet_type", bet_name(F.col("bet_type")).alias("bet_name"), clean_text(F.col("i.kumiBan")).alias("kumi_ban"),
                        money(F.col("i.haraiGaku")).alias("payout"), money(F.col("i.ninki")).alias("popularity"))


def to_odds(messages: DataFrame) -> DataFrame:
    """Positional price lists to long rows; prices above zero only, the upper price for W only."""
    parsed = messages.select("race_date", "place_code", "race_no", F.from_json("odds_json", PRICES_SCHEMA).alias("d"))
    lists = F.array(*[F.struct(F.lit(bet).alias("bet_type"), F.col(f"d.{k}").alias("items")) for k, bet in PRICE_LISTS.items()])
    rows = parsed.select("race_date", "place_code", "race_no", F.col("d.official_dt").alias("official_dt"), F.inline(lists)).select(
        "race_date", "place_code", "race_no", "official_dt", "bet_type", F.explode("items").alias("i"))
    at = lambda k: F.get(F.col("i"), F.lit(k))
    priced = rows.withColumn("odds", at(1).try_cast("double")).where((F.size("i") >= 2) & (F.col("odds") > 0))
    return priced.select(
        "race_date", "place_code", "race_no", "bet_type", format_combo(at(0), F.col("bet_type")).alias("kumi_ban"), "odds",
        F.when(F.col("bet_type") == "W", at(2).try_cast("double")).alias("max_odds"), at(3).try_cast("int").alias("popularity"), "official_dt")
