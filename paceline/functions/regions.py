"""Prefecture to region. One prefecture (山形) is absent and maps to the default."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Each region with its prefectures.
REGION_PREFECTURES = {
    "北日本": ["北海道", "青森", "秋田", "岩手", "宮城", "福島"],
    "関東": ["茨城", "栃木", "群馬", "埼玉", "千葉", "東京", "神奈川", "山梨", "新潟"],
    "中部": ["静岡", "愛知", "岐阜", "三重", "富山", "石川", "福井", "長野"],
    "近畿": ["滋賀", "京都", "大阪", "兵庫", "奈良", "和歌山"],
    "中国": ["鳥取", "島根", "岡山", "広島", "山口"],
    "四国": ["徳島", "香川", "愛媛", "高知"],
    "九州": ["福岡", "佐賀", "長崎", "熊本", "大分", "宮崎", "鹿児島", "沖縄"],
}
UNKNOWN_REGION = "不明"
PREFECTURES = [p for names in REGION_PREFECTURES.values() for p in names] + ["山形"]


def add_region(df: DataFrame, prefecture: str = "prefecture", name: str = "region") -> DataFrame:
    """Left join against the fixed table (46 rows, so it is broadcast)."""
    rows = [(p, r) for r, names in REGION_PREFECTURES.items() for p in names]
    dim = df.sparkSession.createDataFrame(rows, f"_pref string, {name} string")
    joined = df.join(F.broadcast(dim), F.translate(prefecture, " 　", "") == F.col("_pref"), "left").drop("_pref")
    return joined.withColumn(name, F.coalesce(name, F.lit(UNKNOWN_REGION)))


def strip_spaces(col: Column) -> Column:
    """Remove half-width and full-width spaces."""
    return F.translate(col, " 　", "")
