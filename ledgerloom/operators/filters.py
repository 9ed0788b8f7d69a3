"""Row filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import back


def date_slice(df: DataFrame, ts: str, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Rows with start <= ts < end. The bare column is compared, so the bounds reach the Parquet scan."""
    return df.where((F.col(ts) >= F.lit(start).cast("date")) & (F.col(ts) < F.lit(end).cast("date")))


def recent(df: DataFrame, ts: str, as_of: dt.date, n: int, unit: str = "days") -> DataFrame:
    """Rows not older than n days, n months or n whole months before ``as_of``."""
    return df.where(F.col(ts) >= back(as_of, n, unit))


def qualify(df: DataFrame, measure: Column, keep) -> DataFrame:
    """Filter on a window expression: ``keep`` gets the computed column and returns the condition."""
    return df.withColumn("_qualify", measure).where(keep(F.col("_qualify"))).drop("_qualify")


def without_unnamed(df: DataFrame, kind: str, value: str, name: str) -> DataFrame:
    """Drop the rows of one kind that lack a name; rows of other or unknown kind stay out of the test."""
    return df.where(~((F.col(kind) == value) & F.col(name).isNull()))
