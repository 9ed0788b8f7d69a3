"""Grouped results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def agg_all(df: DataFrame, keys: dict[str, Column], aggs: dict[str, Column]) -> DataFrame:
    """GROUP BY every output that is not an aggregate."""
    return df.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(*[c.alias(n) for n, c in aggs.items()])


def duplicates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values that occur more than once, with their count."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def waterfall(df: DataFrame, cols: Sequence[str], total_name: str = "total") -> DataFrame:
    """One bar per column with its sum, and a last bar with the sum of all, rounded to two places."""
    sums = df.agg(*[F.sum(F.col(c).cast("decimal(38,6)")).alias(c) for c in cols])
    whole = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    bars = [(i, c, F.col(c), "relative") for i, c in enumerate(cols)] + [(len(cols), total_name, whole, "total")]
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("measure"),
                F.round(value.cast("decimal(38,6)"), 2).cast("double").alias("amount"),
                F.lit(kind).alias("kind"),
            )
            for i, name, value, kind in bars
        ]
    )
    return sums.select(F.inline(rows))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()
