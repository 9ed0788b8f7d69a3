"""Date and time columns. No function reads the clock: "today" is always passed in."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNITS = {"days": "DAY", "weeks": "WEEK", "months": "MONTH", "years": "YEAR"}


def date_of(ts: Column) -> Column:
    return F.to_date(ts)


def datetime_of(value: Column) -> Column:
    """Date, text or timestamp as a datetime without zone."""
    return value.cast("timestamp_ntz")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_number(ts: Column) -> Column:
    """2024-03-05 becomes 202403."""
    return F.year(ts) * 100 + F.month(ts)


def months_apart(later: Column, earlier: Column) -> Column:
    """Calendar month boundaries between two dates (Jan 31 to Feb 1 is one)."""
    return (F.year(later) * 12 + F.month(later)) - (F.year(earlier) * 12 + F.month(earlier))


def back(as_of: dt.date, n: int, unit: str) -> Column:
    """Start of a recency window. ``whole_months`` counts from the first day of the month of ``as_of``."""
    today = F.lit(as_of).cast("date")
    if unit == "days":
        return F.date_sub(today, n)
    if unit == "months":
        return F.add_months(today, -n)
    if unit == "whole_months":
        return F.add_months(F.trunc(today, "MM"), -n)
    raise ValueError(f"unknown unit {unit!r}")


def to_gmt7(text: Column) -> Column:
    """Mail date such as ``Mon, 5 Feb 2024 23:10:00 -0500 (EST)`` as the text of that instant seven hours east of
    Greenwich; NULL if the text has another shape. The offset's minutes count too."""
    trimmed = F.trim(F.split_part(text, F.lit("("), F.lit(1)))
    shape = r"^(?:[A-Za-z]{3}, *)?(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}) ([+-])(\d{2})(\d{2})$"
    local = F.try_to_timestamp(F.nullif(F.regexp_extract(trimmed, shape, 1), F.lit("")), F.lit("d MMM yyyy HH:mm:ss"))
    sign = F.when(F.regexp_extract(trimmed, shape, 2) == "-", -1).otherwise(1)
    hours = _digits(trimmed, shape, 3)
    minutes = _digits(trimmed, shape, 4)
    shift = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(7 * 60) - sign * (hours * 60 + minutes))
    return F.date_format(local.cast("timestamp_ntz") + shift, "EEE, dd MMM yyyy HH:mm:ss")


def _digits(text: Column, shape: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, shape, group), F.lit("")).cast("int")


def now_text(kind: str, as_of_utc: dt.datetime) -> Column:
    """The passed UTC instant written in the zone seven hours east, as date, time or datetime text."""
    shapes = {"date": "yyyy-MM-dd", "time": "'T'HH:mm:ss", "datetime": "yyyy-MM-dd'T'HH:mm:ss"}
    local = F.lit(as_of_utc.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz") + F.expr("INTERVAL 7 HOURS")
    return F.date_format(local, shapes.get(kind, shapes["datetime"]))


def spine_array(start: Column, end: Column, n: int = 1, unit: str = "days") -> Column:
    """All steps from start to end, end included."""
    return F.sequence(start, end, F.expr(f"INTERVAL {int(n)} {UNITS[unit]}"))


def falling_text(start: Column, end: Column, n: int = 1, unit: str = "days") -> Column:
    """All steps counted down from end to start, as ``yyyy-MM-dd`` text."""
    steps = F.sequence(end, start, -F.expr(f"INTERVAL {int(n)} {UNITS[unit]}"))
    return F.transform(steps, lambda d: F.date_format(d, "yyyy-MM-dd"))


def date_spine(
    spark: SparkSession,
    start: dt.date,
    end: dt.date | None = None,
    n: int = 1,
    unit: str = "days",
    ascending: bool = True,
) -> DataFrame:
    """One row per step. Ascending gives dates counted up from the start; descending gives ``yyyy-MM-dd`` text counted
    down from the end. Without an end the spine has the start and one step after it."""
    step = F.expr(f"INTERVAL {int(n)} {UNITS[unit]}")
    first = F.lit(start).cast("date")
    last = F.lit(end).cast("date") if end is not None else (first + step).cast("date")
    if ascending:
        steps = F.sequence(first, last, step)
    else:
        steps = falling_text(first, last, n, unit)
    steps = F.when(first <= last, steps)
    return spark.range(1).select(F.explode(steps).alias("step"))


def month_windows(start: dt.date, end: dt.date) -> list[tuple[dt.date, dt.date]]:
    """Consecutive pairs of month steps between two dates: the slices of a backfill."""
    steps, current = [], start
    while current <= end:
        steps.append(current)
        current = _add_months(start, len(steps))
    return list(zip(steps, steps[1:]))


def refresh_windows(as_of: dt.date, backfill: bool = False) -> list[tuple[dt.date, dt.date]]:
    """Monthly slices up to the start of next month: the full history from 2022 on, or the last four months."""
    this_month = as_of.replace(day=1)
    start = dt.date(2022, 1, 1) if backfill else _add_months(this_month, -4)
    return month_windows(start, _add_months(this_month, 1))


def _add_months(day: dt.date, n: int) -> dt.date:
    index = day.year * 12 + day.month - 1 + n
    year, month = divmod(index, 12)
    following = dt.date(year + month // 11, (month + 1) % 12 + 1, 1)
    return min(dt.date(year, month + 1, 1) + dt.timedelta(days=day.day - 1), following - dt.timedelta(days=1))
