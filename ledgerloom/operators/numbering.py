"""Consecutive row numbers over a whole frame without bringing it into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import stage

WITHIN = (1 << 33) - 1  # the low bits of monotonically_increasing_id count rows inside a partition


def number_rows(df: DataFrame, order: Sequence[str | Column], name: str = "row_number", start: int = 1) -> DataFrame:
    """Add start, start+1, ... in the given order.

    Rows are range-partitioned by the order columns and numbered inside their partition; the numbered rows are
    stored, and each partition's number is shifted by the rows before it. Only one count per partition is summed up
    in a single place. Give an order without ties for a repeatable result; ties still get distinct numbers.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(placed.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(F.col("_place"), 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    number = F.col("_offset") + F.col("_place").bitwiseAND(WITHIN) + start
    return numbered.select(*df.columns, number.alias(name))
