"""Queries and their oracle SQL, by operator name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from paceline.functions.numeric import settle
from paceline.plans.sqlkit import with_ctes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(
    name: str, sql: str | None = None, dbl: str = "", dt: str = "", ts: str = "", ctes: dict[str, str] | None = None
) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it has no SQL twin and pytest covers it instead.

    ``dbl``, ``dt`` and ``ts`` name the result columns of the SQL that are doubles, dates and
    timestamps; they are brought to the same form as ``tidy`` gives the Spark side.
    """

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf: tidy(fn(spark, sf))
        if sql is not None:
            forms = [f"CASE WHEN abs({c}) < 1000 THEN round(CAST({c} AS DOUBLE) * 1e9) / 1e9 + 0.0 "
                     f"ELSE round(CAST({c} AS DOUBLE) * 1e4) / 1e4 + 0.0 END AS {c}" for c in dbl.split()]
            forms += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dt.split()]
            forms += [f"strftime({c}, '%Y-%m-%d %H:%M:%S.%g') AS {c}" for c in ts.split()]
            body = sql.strip()
            if forms:
                body = f"SELECT * REPLACE ({', '.join(forms)}) FROM (\n{body}\n)"
            ORACLES[name] = with_ctes(body, ctes)
        return fn

    return add


def tidy(df: DataFrame) -> DataFrame:
    """Result form: doubles at nine digits (four from 1000 on), dates and timestamps as text."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind in ("double", "float"):
            x = c.cast("double")
            c = F.when(F.abs(x) < 1000, settle(x, 9) + F.lit(0.0)).otherwise(settle(x, 4) + F.lit(0.0))
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind in ("timestamp_ntz", "timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")
        out.append(c.alias(name))
    return df.select(*out)
