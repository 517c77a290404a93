"""Calendar windows and gaps over zone-less timestamps."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(day: str | date) -> date:
    return day if isinstance(day, date) else date.fromisoformat(day)


def instant(day: str | date) -> Column:
    return F.lit(f"{as_date(day)} 00:00:00").cast("timestamp_ntz")


def between_days(ts: Column, first: str | date, last: str | date) -> Column:
    """Both days included, as a plain range so that scans can skip row groups."""
    return (ts >= instant(first)) & (ts < instant(as_date(last) + timedelta(days=1)))


def lookback(ts: Column, end: str | date, days: int) -> Column:
    """``end`` and the ``days`` days before it."""
    return between_days(ts, as_date(end) - timedelta(days=days), end)


def days_until(day: str | date, ts: Column) -> Column:
    return F.datediff(F.lit(as_date(day)), F.to_date(ts))


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def whole_seconds(later: Column, earlier: Column) -> Column:
    """Elapsed seconds, truncated toward zero."""
    return ((micros(later) - micros(earlier)) / 1_000_000).cast("bigint")


def seconds_of_day_gap(later: Column, earlier: Column) -> Column:
    """Seconds part of a difference with whole days dropped; wraps for negative gaps."""
    return F.pmod(F.floor((micros(later) - micros(earlier)) / 1_000_000), F.lit(86_400)).cast("bigint")


# Fixed values: (month, day) of the holidays.
HOLIDAYS = ["01-01", "01-07", "05-01", "05-09", "06-12", "11-04"]


def date_parts(ts: Column, prefix: str = "") -> dict[str, Column]:
    return {
        f"{prefix}hour": F.hour(ts),
        f"{prefix}dow": F.weekday(ts),
        f"{prefix}day": F.dayofmonth(ts),
        f"{prefix}month": F.month(ts),
        f"{prefix}week": F.weekofyear(ts),
    }


def is_holiday(ts: Column) -> Column:
    return F.date_format(ts, "MM-dd").isin(*HOLIDAYS).cast("int")


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")
