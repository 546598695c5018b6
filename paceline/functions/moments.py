"""Dates, start times, capture offsets."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def month_of(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def monday_of(date: Column) -> Column:
    return F.to_date(F.date_trunc("week", date))


def months_between(first: Column, last: Column) -> Column:
    """Array of month names ``first``..``last``, both included."""
    days = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
    return F.transform(days, lambda d: F.date_format(d, "yyyy-MM"))


def start_ts(date: Column, hhmm: Column) -> Column:
    """Date and ``HH:MM`` or ``HH:MM:SS``; anything else is NULL."""
    text = F.trim(hhmm)
    full = F.when(F.length(text) == 5, F.concat(text, F.lit(":00"))).otherwise(text)
    return F.try_to_timestamp(F.concat_ws(" ", date.cast("string"), full), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def minus_minutes(ts: Column, minutes: Column) -> Column:
    return ts - F.make_dt_interval(secs=(minutes * 60).cast("decimal(18,6)"))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Signed seconds with microsecond precision."""
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / 1e6


def report_window(today: str, days: int | None = None, since: str | None = None) -> tuple[str, str]:
    """Closed date range ``today-days..today``, or from ``since`` when that is given."""
    import datetime as dt

    end = dt.date.fromisoformat(today)
    start = dt.date.fromisoformat(since) if since else end - dt.timedelta(days=days or 0)
    return start.isoformat(), end.isoformat()
