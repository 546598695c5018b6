"""Filters, cleaning, scalar functions and limits (2.2, 2.6, 2.8) over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.functions import moments as mo, numeric as nu, text as tx
from paceline.functions.hashing import hash_rows
from paceline.functions.regions import add_region, strip_spaces
from paceline.keys import CAR, COMBO, RACE
from paceline.operators import cleaning as cl, features as fe, joins as jo, market as mk
from paceline.operators.dedup import dedup_latest
from paceline.plans import bindings as b
from paceline.plans.features import LINES, MARGINALS, WEAK, marginals
from paceline.plans.registry import query
from paceline.plans.statistics import SCORED, scored

R = "race_date, place_code, race_no"


@query("filter_date_range", f"SELECT {R}, car_no FROM runners WHERE race_date BETWEEN DATE '1998-01-01' AND DATE '1999-12-31'", dt="race_date")
def _(spark, sf):
    return cl.date_range(b.runners(spark, sf), "1998-01-01", "1999-12-31").select(*CAR)


@query("filter_positive_odds", f"SELECT {R}, bet_type, kumi_ban, odds, snapshot_dt FROM snapshots WHERE odds > 0", dbl="odds", dt="race_date", ts="snapshot_dt")
def _(spark, sf):
    quoted = b.snapshots(spark, sf).withColumn("odds", F.col("odds").cast("string"))
    return cl.positive_odds(quoted).select(*COMBO, "odds", "snapshot_dt")


@query("filter_clean_races", f"SELECT {R}, car_no, y_win FROM scored QUALIFY sum(y_win) OVER (PARTITION BY {R}) = 1", dt="race_date", ctes=SCORED)
def _(spark, sf):
    return cl.clean_races(scored(spark, sf)).select(*CAR, "y_win")


PRICED = {
    "first_price": f"""SELECT {R}, CAST(split_part(kumi_ban, '-', 1) AS INT) AS car_no, sum(1 / odds) AS m FROM latest_odds WHERE bet_type = 'ST2' GROUP BY ALL""",
    "cars_priced": """SELECT r.race_date, r.place_code, r.race_no, r.car_no, m FROM runners r LEFT JOIN first_price f ON r.race_no = f.race_no AND r.car_no = f.car_no""",
}


@query("filter_complete_market", f"SELECT {R}, car_no FROM cars_priced QUALIFY count(*) OVER (PARTITION BY {R}) = count(m) OVER (PARTITION BY {R})",
       dt="race_date", ctes=PRICED)
def _(spark, sf):
    priced = mk.devig_first_marginal(dedup_latest(b.snapshots(spark, sf), b.SNAP_TIES), complete=False)
    return cl.complete_market(b.runners(spark, sf).select(*CAR).join(priced, CAR, "left")).select(*CAR)


@query("filter_mass_band", f"""SELECT {R}, car_no, p_win FROM predictions QUALIFY count(car_no) OVER (PARTITION BY {R}) >= 5
  AND sum(p_win) OVER (PARTITION BY {R}) > 0.995 AND sum(p_win) OVER (PARTITION BY {R}) < 1.005""", dbl="p_win", dt="race_date")
def _(spark, sf):
    return cl.mass_band(b.predictions(spark, sf), "p_win").select(*CAR, "p_win")


RAW_PAY = {"raw_pay": """SELECT race_date, place_code, race_no, bet_type, kumi_ban, popularity * 10 - 50 AS payout, snapshot_dt, l_partkey, l_suppkey, odds FROM snapshots"""}


@query("payouts_clean", f"""
SELECT {R}, bet_type, kumi_ban, payout, payout / 100 AS realized_odds FROM raw_pay WHERE payout > 0 QUALIFY row_number() OVER (
  PARTITION BY {R}, bet_type, kumi_ban ORDER BY snapshot_dt DESC, l_partkey DESC, l_suppkey DESC, payout DESC) = 1""",
       dbl="realized_odds", dt="race_date", ctes=RAW_PAY)
def _(spark, sf):
    raw = b.snapshots(spark, sf).withColumn("payout", F.col("popularity") * 10 - 50)
    return cl.payouts_clean(raw, [F.col("snapshot_dt"), F.col("l_partkey"), F.col("l_suppkey"), F.col("payout")])


@query("distinct_races", f"SELECT {R}, min(st_time) AS st_time FROM runners GROUP BY ALL", dt="race_date")
def _(spark, sf):
    return cl.distinct_races(b.runners(spark, sf))


@query("coerce_numeric", """
SELECT doc_id, source, TRY_CAST(trim(lang) AS INT) AS lang_no, TRY_CAST(trim(CAST(n_chars AS VARCHAR)) AS INT) AS n_chars FROM documents
WHERE TRY_CAST(trim(CAST(n_chars AS VARCHAR)) AS INT) IS NOT NULL""")
def _(spark, sf):
    docs = b.table(spark, sf, "documents").select("doc_id", "source", F.col("lang").alias("lang_no"), "n_chars")
    return cl.coerce_numeric(docs, {"lang_no": "int", "n_chars": "int"}, ["n_chars"])


@query("impute_flags", f"""
SELECT r.race_date, r.place_code, r.race_no, r.car_no, coalesce(has_odds, 0) AS has_odds, coalesce(is_incomplete_st2, 1) AS is_incomplete_st2,
  coalesce(np, (SELECT quantile_cont(np, 0.5) FROM imp_base)) AS nige_propensity FROM imp_base r LEFT JOIN marginals m ON r.race_no = m.race_no AND r.car_no = m.car_no""",
       dbl="nige_propensity", dt="race_date", ctes={**MARGINALS, **WEAK, "imp_base": f"""SELECT w.race_date, w.place_code, w.race_no, w.car_no,
         CASE WHEN r.syouritu IS NOT NULL THEN round(w.nige_propensity * 1e9) / 1e9 END AS np FROM weak w JOIN runners r ON w.race_no = r.race_no AND w.car_no = r.car_no"""})
def _(spark, sf):
    r = b.runners(spark, sf)
    known = fe.weak_line_features(r).join(r.select(*CAR, "syouritu"), CAR)
    tempo = F.when(F.col("syouritu").isNotNull(), nu.settle(F.col("nige_propensity")))
    df = known.select(*CAR, tempo.alias("nige_propensity")).join(marginals(spark, sf), CAR, "left")
    return cl.impute_flags(df).select(*CAR, "has_odds", "is_incomplete_st2", "nige_propensity")


@query("null_preserving_feature", f"""
SELECT r.race_date, r.place_code, r.race_no, r.car_no, line_size, pos_ratio FROM runners r LEFT JOIN
  (SELECT x.* FROM real_lines x JOIN races q ON x.race_no = q.race_no WHERE segment = 'BUILDING') l ON r.race_no = l.race_no AND r.car_no = l.car_no""",
       dbl="pos_ratio", dt="race_date", ctes=LINES)
def _(spark, sf):
    r = b.runners(spark, sf)
    some = b.races(spark, sf).where(F.col("segment") == "BUILDING").select(*RACE)
    covered = fe.real_line_features(b.narabi(spark, sf).join(some, RACE, "left_semi"), r)
    return cl.attach_sparse(r.select(*CAR), covered).select(*CAR, "line_size", "pos_ratio")


@query("parse_bool_text", "SELECT race_date, place_code, lower(is_canceled) IN ('true', '1') AS off FROM meta", dt="race_date")
def _(spark, sf):
    return b.meta(spark, sf).select("race_date", "place_code", tx.truthy(F.col("is_canceled")).alias("off"))


@query("type_normalise_keys", f"SELECT {R}, car_no, tyaku FROM results", dt="race_date")
def _(spark, sf):
    as_text = b.results(spark, sf).select(*[F.col(c).cast("string") for c in CAR], "tyaku")
    keyed = jo.normalise_keys(as_text, {"race_date": "date", "place_code": "int", "race_no": "bigint", "car_no": "int"})
    return b.runners(spark, sf).select(*CAR).join(keyed, CAR)


@query("clean_text", """
SELECT doc_id, CASE WHEN trim(lang) IN ('', 'null') THEN NULL ELSE trim(lang) END AS lang,
  translate(concat('Ａ１', lang, '　Ｂ'), 'Ａ１Ｂ　', 'A1B ') AS wide, concat('1(株)', lang, 'ガ') AS folded, lang AS padded, NULL AS blank, length(trim(text, ' ')) AS n FROM documents""")
def _(spark, sf):
    d = b.table(spark, sf, "documents")
    return d.select("doc_id", tx.clean_text(F.col("lang")).alias("lang"),
                    tx.clean_text(F.concat(F.lit("Ａ１"), "lang", F.lit("　Ｂ"))).alias("wide"),
                    tx.clean_text(F.concat(F.lit("①㈱"), "lang", F.lit("ｶﾞ"))).alias("folded"),
                    tx.clean_text(F.concat(F.lit("　　"), "lang", F.lit("　 "))).alias("padded"), tx.clean_text(F.lit("　")).alias("blank"),
                    F.length(F.trim("text")).cast("long").alias("n"))


# --- 2.6 ----------------------------------------------------------------------------------------


@query("top_n_report", f"""
SELECT {R}, total, greatest((SELECT count(*) FROM races) - 15, 0) AS n_rest FROM races ORDER BY total DESC, {R} LIMIT 15""", dbl="total", dt="race_date")
def _(spark, sf):
    r = b.races(spark, sf).select(*RACE, "total")
    return cl.top_n_report(r, [F.desc("total"), *[F.col(c) for c in RACE]])


@query("stratified_head", f"""
SELECT {R}, segment, total, CAST(rk AS INT) AS rk FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY total DESC, {R}) AS rk FROM races)
WHERE rk <= 20 ORDER BY rk, segment, total DESC, {R} LIMIT 60""", dbl="total", dt="race_date")
def _(spark, sf):
    r = b.races(spark, sf).select(*RACE, "segment", "total")
    return cl.stratified_head(r, "segment", [F.desc("total"), *[F.col(c) for c in RACE]], 20, 60)


@query("max_rows_sample", f"""SELECT {R}, bet_type, kumi_ban, odds FROM snapshots ORDER BY race_no, snapshot_dt, l_partkey, l_suppkey, bet_type, kumi_ban, odds LIMIT 1000""",
       dbl="odds", dt="race_date")
def _(spark, sf):
    order = ["race_no", "snapshot_dt", "l_partkey", "l_suppkey", "bet_type", "kumi_ban", "odds"]
    return cl.max_rows_sample(b.snapshots(spark, sf), [F.col(c) for c in order], 1000).select(*COMBO, "odds")


# --- 2.8 ----------------------------------------------------------------------------------------


@query("str_format_combo", f"""
SELECT {R}, bet_type, kumi_ban AS formatted FROM snapshots""", dt="race_date")
def _(spark, sf):
    raw = F.array_join(F.transform(tx.car_numbers(F.col("kumi_ban")), lambda x: F.lpad(x.cast("string"), 2, "0")), "")
    s = b.snapshots(spark, sf).withColumn("raw", raw)
    return s.select(*RACE, "bet_type", tx.format_combo(F.col("raw"), F.col("bet_type")).alias("formatted"))


@query("str_parse_pair", f"""
SELECT {R}, bet_type, kumi_ban, CASE WHEN len(n) = 2 AND n[1] <> n[2] THEN least(n[1], n[2]) END AS lo,
  CASE WHEN len(n) = 2 AND n[1] <> n[2] THEN greatest(n[1], n[2]) END AS hi FROM (
  SELECT *, list_transform(regexp_extract_all(kumi_ban, '(\\d+)', 1), lambda x: CAST(x AS INT)) AS n FROM snapshots)""", dt="race_date")
def _(spark, sf):
    p = tx.pair_of(F.col("kumi_ban"))
    return b.snapshots(spark, sf).withColumn("p", p).select(*COMBO, "p.lo", "p.hi")


@query("str_split_cars", f"""
SELECT {R}, kumi_ban, TRY_CAST(split_part(replace(kumi_ban, '=', '-'), '-', 1) AS INT) AS first_car,
  TRY_CAST(split_part(replace(kumi_ban, '=', '-'), '-', 2) AS INT) AS second_car FROM snapshots""", dt="race_date")
def _(spark, sf):
    k = F.col("kumi_ban")
    return b.snapshots(spark, sf).select(*RACE, "kumi_ban", tx.car_at(k, 1).alias("first_car"), tx.car_at(k, 2).alias("second_car"))


@query("str_race_id", f"""SELECT concat(strftime(race_date, '%Y%m%d'), CASE WHEN place_code < 10 THEN concat('0', place_code) ELSE CAST(place_code AS VARCHAR) END,
  CASE WHEN race_no < 10 THEN concat('0', race_no) ELSE CAST(race_no AS VARCHAR) END) AS race_id FROM races""")
def _(spark, sf):
    return b.races(spark, sf).select(tx.race_id(F.col("race_date"), F.col("place_code"), F.col("race_no")).alias("race_id"))


@query("str_race_key", f"SELECT concat_ws('|', strftime(race_date, '%Y-%m-%d'), place_code, race_no) AS k, concat_ws('_', strftime(race_date, '%Y-%m-%d'), place_code, race_no) AS u FROM races")
def _(spark, sf):
    keys = [F.col(c) for c in RACE]
    return b.races(spark, sf).select(tx.race_key(keys).alias("k"), tx.race_key(keys, "_").alias("u"))


@query("str_strip_spaces", "SELECT conv_id, turn, replace(replace(text, ' ', ''), '　', '') AS packed FROM conversations")
def _(spark, sf):
    return b.table(spark, sf, "conversations").select("conv_id", "turn", strip_spaces(F.col("text")).alias("packed"))


@query("str_prefix_class", f"SELECT {R}, car_no, kyuhan LIKE 'S%' AS is_s FROM runners", dt="race_date")
def _(spark, sf):
    return b.runners(spark, sf).select(*CAR, F.col("kyuhan").startswith("S").alias("is_s"))


@query("str_money", f"SELECT {R}, bet_type, kumi_ban, CASE WHEN payout > 1000 THEN payout END AS payout, payout AS rank_no FROM payouts", dt="race_date")
def _(spark, sf):
    p = b.payouts(spark, sf)
    text = F.when(F.col("payout") > 1000, F.format_number("payout", 0)).otherwise(F.lit(tx.UNSOLD[1]))
    ranked = F.concat(F.lit("("), F.col("payout").cast("string"), F.lit(")"))
    return p.select(*COMBO, tx.money(text).alias("payout"), tx.money(ranked).alias("rank_no"))


@query("map_region", f"SELECT {R}, car_no, prefecture, coalesce(region, '不明') AS region FROM runners LEFT JOIN regions USING (prefecture)", dt="race_date")
def _(spark, sf):
    return add_region(b.runners(spark, sf)).select(*CAR, "prefecture", "region")


@query("date_month", "SELECT strftime(race_date, '%Y-%m') AS month, count(*) AS n FROM races GROUP BY 1")
def _(spark, sf):
    return b.races(spark, sf).groupBy(mo.month_of(F.col("race_date")).alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("date_month_range", """
SELECT place_code, strftime(m, '%Y-%m') AS month FROM (SELECT place_code, unnest(range(date_trunc('month', min(race_date)),
  date_trunc('month', max(race_date)) + INTERVAL 1 DAY, INTERVAL 1 MONTH)) AS m FROM races GROUP BY 1)""")
def _(spark, sf):
    ends = b.races(spark, sf).groupBy("place_code").agg(F.min("race_date").alias("a"), F.max("race_date").alias("z"))
    return ends.select("place_code", F.explode(mo.months_between(F.col("a"), F.col("z"))).alias("month"))


@query("date_week_monday", "SELECT race_date, CAST(date_trunc('week', race_date) AS DATE) AS monday FROM races", dt="race_date monday")
def _(spark, sf):
    return b.races(spark, sf).select("race_date", mo.monday_of(F.col("race_date")).alias("monday"))


@query("date_report_window", "SELECT race_date, count(*) AS n FROM races WHERE race_date BETWEEN DATE '2001-08-01' - 28 AND DATE '2001-08-01' GROUP BY 1", dt="race_date")
def _(spark, sf):
    start, end = mo.report_window("2001-08-01", days=28)
    return cl.date_range(b.races(spark, sf), start, end).groupBy("race_date").agg(F.count(F.lit(1)).alias("n"))


@query("ts_start", f"SELECT {R}, CAST(concat(strftime(race_date, '%Y-%m-%d'), ' ', st_time, ':00') AS TIMESTAMP) AS start_dt, CAST(NULL AS BOOLEAN) IS NULL AS bad_is_null FROM races",
       dt="race_date", ts="start_dt")
def _(spark, sf):
    bad = mo.start_ts(F.col("race_date"), F.concat(F.lit("x"), "st_time")).isNull()
    return b.races(spark, sf).select(*RACE, mo.start_ts(F.col("race_date"), F.col("st_time")).alias("start_dt"), bad.alias("bad_is_null"))


@query("ts_offsets", f"""
SELECT {R}, target_offset_min, start_dt - to_microseconds(CAST(target_offset_min * 60000000 AS BIGINT)) AS planned,
  (epoch_us(start_dt) - epoch_us(snapshot_dt)) / 1e6 AS before_sec FROM capture_log""", dbl="target_offset_min before_sec", dt="race_date", ts="planned")
def _(spark, sf):
    return b.capture_log(spark, sf).select(
        *RACE, "target_offset_min", mo.minus_minutes(F.col("start_dt"), F.col("target_offset_min")).alias("planned"),
        mo.seconds_between(F.col("start_dt"), F.col("snapshot_dt")).alias("before_sec"))


@query("num_normalise_offset", "SELECT CASE WHEN target_offset_min = floor(target_offset_min) THEN CAST(CAST(target_offset_min AS INT) AS VARCHAR) ELSE CAST(target_offset_min AS VARCHAR) END AS label, count(*) AS n FROM capture_log GROUP BY 1")
def _(spark, sf):
    return b.capture_log(spark, sf).groupBy(nu.offset_label(F.col("target_offset_min")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("num_clip_logit", f"""
SELECT {R}, car_no, ln(q / (1 - q)) AS z, q AS back FROM (SELECT *, least(greatest(p_win, 1e-4), 1 - 1e-4) AS q FROM predictions)""", dbl="z back", dt="race_date")
def _(spark, sf):
    z = nu.logit(F.col("p_win"))
    return b.predictions(spark, sf).select(*CAR, z.alias("z"), nu.sigmoid(z).alias("back"))


@query("num_front_run_ratio", f"SELECT {R}, car_no, nige_cnt / (nige_cnt + makuri_cnt + sasi_cnt + 1) AS ratio FROM runners", dbl="ratio", dt="race_date")
def _(spark, sf):
    return b.runners(spark, sf).select(*CAR, nu.front_run_ratio(F.col("nige_cnt"), F.col("makuri_cnt"), F.col("sasi_cnt")).alias("ratio"))


@query("num_pos_ratio", f"SELECT {R}, car_no, pos_ratio FROM real_lines", dbl="pos_ratio", dt="race_date", ctes=LINES)
def _(spark, sf):
    lines = fe.reconstruct_lines(b.narabi(spark, sf))
    return lines.select(*CAR, nu.position_ratio(F.col("line_pos"), F.col("line_size")).alias("pos_ratio"))


@query("cond_band", """
SELECT odds_band, CASE WHEN h < 10 THEN 'morning' WHEN h < 15 THEN 'day' WHEN h < 20 THEN 'night' ELSE 'midnight' END AS part, count(*) AS n FROM (
  SELECT CAST(substr(st_time, 1, 2) AS INT) AS h, CASE WHEN odds < 1 THEN NULL WHEN odds < 3 THEN '1-3' WHEN odds < 6 THEN '3-6' WHEN odds < 10 THEN '6-10'
    WHEN odds < 20 THEN '10-20' WHEN odds < 50 THEN '20-50' ELSE '50-+' END AS odds_band FROM snapshots s JOIN races r ON s.race_no = r.race_no) GROUP BY 1, 2""")
def _(spark, sf):
    df = b.snapshots(spark, sf).join(b.races(spark, sf).select(*RACE, "st_time"), RACE)
    return df.groupBy(nu.band(F.col("odds"), mk.BAND_EDGES, mk.BAND_LABELS).alias("odds_band"),
                      nu.start_band(F.col("st_time")).alias("part")).agg(F.count(F.lit(1)).alias("n"))


def _word(at: int) -> str:
    return f"CAST(sum(CAST(CAST('0x' || substr(h, {at}, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR)"


@query("hash_rows", f"""
SELECT race_date, place_code, substr(sha256(concat_ws('|', CAST(count(*) AS VARCHAR), {_word(1)}, {_word(16)}, {_word(31)}, {_word(46)})), 1, 12) AS digest FROM (
  SELECT race_date, place_code, sha256(concat_ws('|', race_no, car_no, CAST(round(p_win * 1e6) AS BIGINT))) AS h FROM predictions) GROUP BY 1, 2""", dt="race_date")
def _(spark, sf):
    text = F.concat_ws("|", "race_no", "car_no", F.round(F.col("p_win") * 1e6).cast("long"))
    return hash_rows(b.predictions(spark, sf), ["race_date", "place_code"], text)
