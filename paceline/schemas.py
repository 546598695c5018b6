"""The domain tables: one explicit schema per table, with fixed column names."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_KINDS = {"date": T.DateType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(),
          "ts": T.TimestampNTZType(), "str": T.StringType()}

_RACE = "race_date:date place_code:int race_no:long"
_CAR = f"{_RACE} car_no:int"

# Table and column names in storage order; a column without a type is text.
_TABLES = {
    "race_meta": "race_date:date place_code:int place_name race_name grade sel_kaisai enc_para_k enc_para_s is_canceled",
    "race_entries": f"{_CAR} player_code player_name prefecture kyaku yosoin itioshi_flag:int aisyo_flag:int assen syumoku "
                    "den_time st_time line_type narabi_flg:int ozz_flg:int result_flg:int",
    "race_lines": f"{_CAR} narabi_x:int narabi_y:int",
    "race_stats": f"{_CAR} player_code player_name prefecture kyuhan prev_kyuhan kyakusitu sotugyouki:int age:int heikin_tokuten:double "
                  "nige_cnt:int makuri_cnt:int sasi_cnt:int mark_cnt:int back_cnt:int home_tori:int st_tori:int syouritu:double "
                  "rentairitu2:double rentairitu3:double ketujyou_tuika_hojyu shumoku_name kyori:int shukai:int kyoso_shurui yudo_sensyu",
    "race_results": f"{_RACE} tyaku:int car_no:int player_code player_name age:int prefecture sotugyouki:int kyuhan tyakusa agari:double "
                    "kimarite bh in_line_jyuni kojin_state tyaku_note tenki husoku",
    "payouts": f"{_RACE} bet_type bet_name kumi_ban payout:int popularity:int",
    "race_odds": f"{_RACE} bet_type kumi_ban odds:double max_odds:double popularity:int official_dt:ts",
    "race_odds_prerace": f"{_RACE} bet_type kumi_ban odds:double max_odds:double popularity:int official_dt:ts snapshot_dt:ts "
                         "minutes_before_start:int target_offset_min:double",
    "prerace_snapshot_log": f"{_RACE} st_time snapshot_dt:ts minutes_before_start:int target_offset_min:double status n_rows:int note "
                            "scheduled_snapshot_dt:ts seconds_before_start:double capture_lag_sec:double",
    "prerace_capture_timing": f"{_RACE} target_offset_min:double status scheduled_snapshot_dt:ts fetch_start_dt:ts fetch_end_dt:ts "
                              "fetch_sec:double done_lag_sec:double seconds_before_done:double server_date",
    "shadow_predictions": f"{_CAR} p_win:double p_top2:double p_top3:double pred_rank:double predicted_at:ts model_trained_at:ts model_hash "
                          "n_features:int prediction_input_hash code_revision run_id run_type",
    "void_races": "recorded_at:ts race_date:date place_code:int race_no:long reason note",
    "data_gaps": "recorded_at:ts kind race_date:date place_code:int reason",
}
_MONTHLY = re.compile(r"^race_odds_prerace_\d{4}-\d{2}$")


def schema_for(name: str) -> T.StructType:
    """Schema of a table; a monthly price table has the schema of the whole table."""
    base = "race_odds_prerace" if _MONTHLY.match(name) else name
    if base not in _TABLES:
        raise ValueError(f"unknown table: {name}")
    fields = (f.partition(":") for f in _TABLES[base].split())
    return T.StructType([T.StructField(n, _KINDS[k or "str"]) for n, _, k in fields])


def table_names() -> list[str]:
    return list(_TABLES)
