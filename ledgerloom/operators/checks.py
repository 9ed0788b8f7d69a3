"""Data tests: each returns the violating rows, so an empty frame means passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.aggregates import duplicates


def check_query(df: DataFrame) -> bool:
    """A query test passes when it yields no rows."""
    return df.isEmpty()


def check_report(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check with its number of violations."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations")
        for name, df in checks.items()
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("violations") == 0)


def table_report(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row per check with its number of violations, all from one scan of the table.

    A check is an aggregate that counts violations: :func:`nulls`, :func:`surplus`, :func:`no_null`, :func:`broken`,
    :func:`all_blank`, or any other.
    """
    counted = df.agg(*[c.cast("bigint").alias(f"check{i}") for i, c in enumerate(checks.values())])
    rows = [F.struct(F.lit(name).alias("check"), F.col(f"check{i}").alias("violations")) for i, name in enumerate(checks)]
    return counted.select(F.inline(F.array(*rows))).withColumn("passed", F.col("violations") == 0)


def nulls(col: str) -> Column:
    """Rows without a value."""
    return F.count_if(F.col(col).isNull())


def surplus(cols: str | Sequence[str]) -> Column:
    """Rows beyond the first of each value; rows with a NULL among the columns do not count."""
    names = [cols] if isinstance(cols, str) else list(cols)
    known = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in names])
    return F.count_if(known) - F.count_distinct(*names)


def no_null(col: str) -> Column:
    """1 if the column has no NULL at all, also for an empty table."""
    return (nulls(col) == 0).cast("bigint")


def broken(rule: Column) -> Column:
    """Rows for which a rule does not hold; a rule that is NULL does not."""
    return F.count_if(~F.coalesce(rule, F.lit(False)))


def all_blank(cols: Sequence[str]) -> Column:
    """1 if all cells of the columns are NULL or empty text, also for an empty table."""
    filled = reduce(lambda x, y: x | y, [F.coalesce(F.col(f"`{c}`").cast("string") != "", F.lit(False)) for c in cols])
    return (F.count_if(filled) == 0).cast("bigint")


def expect_some_null(df: DataFrame, col: str) -> DataFrame:
    """One row when the column has no NULL at all (also for an empty table), none otherwise."""
    nulls = df.agg(F.count_if(F.col(col).isNull()).alias("nulls"))
    return nulls.where("nulls = 0").select(F.lit(1).alias("violation"))


def expect_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def expect_unique(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Non-NULL values that occur more than once."""
    names = [cols] if isinstance(cols, str) else list(cols)
    return duplicates(df.dropna(subset=names), names)


def is_blank(df: DataFrame) -> DataFrame:
    """One row: are all cells NULL or empty text? True for a table without rows."""
    filled = reduce(
        lambda x, y: x | y,
        [F.col(f"`{c}`").isNotNull() & (F.col(f"`{c}`").cast("string") != "") for c in df.columns],
    )
    return df.agg((F.count_if(filled) == 0).alias("is_blank"))
