"""Oracle SQL: the domain tables as common table expressions over the driver tables."""

from __future__ import annotations

import re

from paceline.functions.regions import PREFECTURES, REGION_PREFECTURES

_PREFS = ", ".join(f"'{p}'" for p in PREFECTURES)
_REGION_ROWS = ", ".join(f"('{p}', '{r}')" for r, ps in REGION_PREFECTURES.items() for p in ps)

CTES: dict[str, str] = {
    "races": """SELECT CAST(o_orderdate AS DATE) AS race_date, c_nationkey AS place_code, o_orderkey AS race_no,
      printf('%02d:%02d', 8 + o_orderkey % 15, (o_orderkey * 7) % 60) AS st_time, o_orderstatus AS status,
      o_orderpriority AS priority, o_totalprice AS total, c_mktsegment AS segment
      FROM orders JOIN customer ON o_custkey = c_custkey""",
    "meta": """SELECT race_date, place_code, min(segment) AS grade,
      CASE WHEN bool_or(priority = '1-URGENT' AND status = 'P') THEN 'True' ELSE 'False' END AS is_canceled
      FROM races GROUP BY 1, 2""",
    "raw_lines": """SELECT race_date, place_code, race_no, lineitem.* FROM lineitem JOIN races ON l_orderkey = race_no""",
    "latest_lines": """SELECT * FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
        l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
        l_linestatus DESC) = 1""",
    "runners": f"""SELECT race_date, place_code, race_no, l_linenumber AS car_no, st_time, status,
      l_partkey AS player_code, ([{_PREFS}])[l_suppkey % {len(PREFECTURES)} + 1] AS prefecture, l_suppkey AS supplier,
      CASE l_returnflag WHEN 'A' THEN '逃' WHEN 'N' THEN '追' ELSE '両' END AS kyaku,
      CASE l_linestatus WHEN 'O' THEN 'S1' ELSE 'A1' END AS kyuhan,
      nullif(l_discount * 100, 0) AS syouritu, l_tax * 100 AS rentairitu2, l_quantity AS rentairitu3,
      l_extendedprice / 1000 AS heikin_tokuten, CAST(l_quantity AS INT) AS age,
      CAST(l_quantity AS INT) % 7 AS nige_cnt, CAST(l_quantity AS INT) % 5 AS makuri_cnt,
      CAST(l_suppkey % 4 AS INT) AS sasi_cnt, l_extendedprice AS price, l_quantity AS qty, l_discount AS disc,
      l_tax AS tax, CAST(l_shipdate AS DATE) AS ship_date
      FROM latest_lines JOIN races ON l_orderkey = race_no""",
    "narabi": """SELECT race_date, place_code, race_no, car_no, car_no + CAST(floor(qty / 25) AS INT) AS narabi_x,
      CASE WHEN kyuhan = 'S1' THEN 1 ELSE 0 END AS narabi_y FROM runners""",
    "results": """SELECT race_date, place_code, race_no, car_no, CASE WHEN disc <> 0 THEN CAST(row_number() OVER (
      PARTITION BY race_date, place_code, race_no ORDER BY qty DESC, car_no) AS INT) END AS tyaku
      FROM runners WHERE status <> 'P'""",
    "predictions": """SELECT race_date, place_code, race_no, car_no, round((price / sum(price) OVER w) * 1e6) / 1e6 AS p_win,
      round((qty / sum(qty) OVER w) * 1e6) / 1e6 AS p_top2, round((price * qty / sum(price * qty) OVER w) * 1e6) / 1e6 AS p_top3, ship_date
      FROM runners WINDOW w AS (PARTITION BY race_date, place_code, race_no)""",
    "podium": """SELECT race_date, place_code, race_no, max(CASE WHEN r = 1 THEN car_no END) AS c1,
      max(CASE WHEN r = 2 THEN car_no END) AS c2, max(CASE WHEN r = 3 THEN car_no END) AS c3
      FROM (SELECT *, row_number() OVER (PARTITION BY race_date, place_code, race_no ORDER BY tyaku) AS r
        FROM results WHERE tyaku IS NOT NULL) WHERE r <= 3 GROUP BY 1, 2, 3""",
    "payouts": """SELECT race_date, place_code, race_no, bet_type, kumi_ban, payout FROM (
      SELECT p.*, CAST(floor(total / 1000) AS INT) + 100 AS base, list_sort([c1, c2, c3]) AS s
      FROM podium p JOIN races USING (race_date, place_code, race_no)
      WHERE status = 'F' OR (status = 'O' AND priority <> '5-LOW')) b,
      LATERAL (VALUES ('SH2', concat(least(c1, c2), '=', greatest(c1, c2)), base, c2),
        ('ST2', concat(c1, '-', c2), base * 2, c2),
        ('RH3', concat(s[1], '=', s[2], '=', s[3]), base * 3, c3),
        ('RT3', concat(c1, '-', c2, '-', c3), base * 6, c3),
        ('W', concat(least(c1, c2), '=', greatest(c1, c2)), base, c3),
        ('W', concat(least(c1, c3), '=', greatest(c1, c3)), base + 10, c3),
        ('W', concat(least(c2, c3), '=', greatest(c2, c3)), base + 20, c3)) t(bet_type, kumi_ban, payout, need)
      WHERE need IS NOT NULL""",
    "snap0": """SELECT *, l_linenumber AS a, (l_linenumber - 1 + CAST(l_partkey % 6 + 1 AS INT)) % 7 + 1 AS b,
      (l_linenumber - 1 + CAST(l_partkey % 6 + 1 AS INT) % 6 + 1) % 7 + 1 AS c,
      CASE concat(l_returnflag, l_linestatus) WHEN 'AF' THEN 'ST2' WHEN 'AO' THEN 'SH2' WHEN 'NF' THEN 'W'
        WHEN 'NO' THEN 'RH3' WHEN 'RF' THEN 'RT3' ELSE 'ST2' END AS bet_type,
      ([5.0::DOUBLE, 3.0, 2.0, 1.0, 0.5])[least(CAST(floor((l_quantity - 1) / 10) AS INT), 4) + 1] AS target_offset_min,
      1 + floor(l_extendedprice / 1000) / 10 AS quoted FROM raw_lines""",
    "snapshots": """SELECT race_date, place_code, race_no, bet_type,
      CASE bet_type WHEN 'ST2' THEN concat(a, '-', b) WHEN 'RT3' THEN concat(a, '-', b, '-', c)
        WHEN 'RH3' THEN array_to_string(list_sort([a, b, c]), '=')
        ELSE concat(least(a, b), '=', greatest(a, b)) END AS kumi_ban,
      CASE WHEN l_tax = 0.08 THEN 0.0 ELSE quoted END AS odds,
      CASE WHEN bet_type = 'W' THEN quoted + round(l_discount * 20, 1) END AS max_odds,
      CAST(l_quantity AS INT) AS popularity, l_shipdate AS snapshot_dt, target_offset_min, l_partkey, l_suppkey
      FROM snap0""",
    "latest_odds": """SELECT * FROM snapshots WHERE odds > 0
      QUALIFY row_number() OVER (PARTITION BY race_date, place_code, race_no, bet_type, kumi_ban ORDER BY
        snapshot_dt DESC, l_partkey DESC, l_suppkey DESC, odds DESC, popularity DESC, target_offset_min DESC) = 1""",
    "share_win": """SELECT race_date, place_code, race_no, car_no, p_win / s AS q FROM (
      SELECT *, sum(p_win) OVER w AS s, count(*) OVER w AS n FROM predictions
      WINDOW w AS (PARTITION BY race_date, place_code, race_no)) WHERE s > 0 AND n >= 2""",
    "pairs": """SELECT a.race_date, a.place_code, a.race_no, a.car_no AS i, b.car_no AS j, a.q AS qi, b.q AS qj
      FROM share_win a JOIN share_win b ON a.race_date = b.race_date AND a.place_code = b.place_code
        AND a.race_no = b.race_no AND a.car_no <> b.car_no""",
    "combos": """SELECT race_date, place_code, race_no, 'ST2' AS bet_type, concat(i, '-', j) AS kumi_ban,
        qi * qj / (1 - qi) AS p_combo FROM pairs WHERE 1 - qi > 0
      UNION ALL SELECT race_date, place_code, race_no, 'SH2', concat(i, '=', j),
        CASE WHEN 1 - qi > 0 THEN qi * qj / (1 - qi) ELSE 0 END + CASE WHEN 1 - qj > 0 THEN qj * qi / (1 - qj) ELSE 0 END
        FROM pairs WHERE i < j""",
    "market": """SELECT race_date, place_code, race_no, bet_type, kumi_ban, 0.75 / p_combo AS odds,
        CAST(NULL AS DOUBLE) AS max_odds FROM combos WHERE p_combo > 0
      UNION ALL SELECT race_date, place_code, race_no, 'W', kumi_ban, 0.75 / p_combo * 0.4, 0.75 / p_combo * 0.7
        FROM combos WHERE p_combo > 0 AND bet_type = 'SH2'""",
    "market_by_offset": """SELECT m.race_date, m.place_code, m.race_no, bet_type, kumi_ban, odds * moved AS odds,
      max_odds * moved AS max_odds, target_offset_min FROM market m JOIN (
        SELECT race_no, off AS target_offset_min, 1 + (total / 500000 - 0.5) / 10 * off AS moved FROM races,
        (VALUES (5.0::DOUBLE), (3.0), (2.0), (1.0), (0.5)) o(off)) d ON m.race_no = d.race_no""",
    "capture_log": """SELECT race_date, place_code, race_no, car_no, start_dt, off AS target_offset_min, status, n_rows,
      start_dt - to_microseconds(CAST(off * 60000000 AS BIGINT)) AS scheduled_snapshot_dt,
      start_dt - to_microseconds(CAST(round((off * 60 - coalesce(lag, 0)) * 1000000) AS BIGINT)) AS snapshot_dt,
      CASE WHEN lag IS NOT NULL THEN off * 60 - lag END AS seconds_before_start, lag AS capture_lag_sec, fetch_sec,
      l_partkey, l_suppkey FROM (
      SELECT s.race_date, s.place_code, s.race_no, l_linenumber AS car_no,
        CAST(concat(strftime(s.race_date, '%Y-%m-%d'), ' ', st_time, ':00') AS TIMESTAMP) AS start_dt,
        target_offset_min AS off, CASE WHEN l_returnflag <> 'N' THEN 'ok' WHEN l_linestatus = 'O' THEN 'no_odds'
          ELSE 'fail' END AS status, CAST(l_quantity AS INT) AS n_rows,
        CASE WHEN l_discount <> 0.1 THEN round(l_tax * 500 - 5, 1) END AS lag, round(l_discount * 30, 1) AS fetch_sec,
        l_partkey, l_suppkey
        FROM snap0 s JOIN races r ON s.race_no = r.race_no)""",
    "voids": """SELECT race_date, place_code, CASE WHEN priority = '3-MEDIUM' THEN race_no END AS race_no,
      CASE WHEN priority = '3-MEDIUM' THEN 'full_refund' ELSE 'day_canceled' END AS reason
      FROM races WHERE status = 'P' AND priority IN ('2-HIGH', '3-MEDIUM')""",
    "official_runs": """SELECT race_date, place_code, race_no, l_linenumber AS car_no,
      round(l_extendedprice / 110000 * 1e6) / 1e6 AS p_win, l_shipdate AS predicted_at, CASE l_returnflag WHEN 'A' THEN 'official'
      WHEN 'N' THEN 'rerun' ELSE 'legacy_unverifiable' END AS run_type, l_partkey, l_suppkey, l_quantity FROM raw_lines""",
    "official": """SELECT * FROM official_runs WHERE run_type = 'official' QUALIFY row_number() OVER (
      PARTITION BY race_date, place_code, race_no, car_no
      ORDER BY predicted_at DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, p_win DESC) = 1""",
    "regions": f"SELECT * FROM (VALUES {_REGION_ROWS}) r(prefecture, region)",
}


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the CTEs it names, directly or through others, in dependency order."""
    known = {**CTES, **(extra or {})}
    order: list[str] = []
    seen: set[str] = set()

    def need(text: str) -> None:
        for name in known:
            if name not in seen and re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", text):
                seen.add(name)
                need(known[name])
                order.append(name)

    need(body)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in order) + "\n" + body
