"""Per-group questions that SQL asks with window functions.

A plain whole-partition window puts all rows of a key into one task. The group-wide sums here are aggregated first
(partial aggregation on the map side) and joined back with heavy keys split; only the one-row-per-key pick stays a
window, because Spark cuts it to one row per key and task before the shuffle (WindowGroupLimit).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.joins import as_list, even_join


def latest_per_key(
    df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], tie: str | Sequence[str] = ()
) -> DataFrame:
    """The row with the greatest ``order`` per key; ``tie`` (ascending) decides between equals. NULL keys are a key."""
    ranked = [F.col(c).desc() for c in as_list(order)] + [F.col(c).asc() for c in as_list(tie)]
    window = Window.partitionBy(*as_list(keys)).orderBy(*ranked)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def any_in_group(df: DataFrame, key: str, condition: Column, name: str) -> DataFrame:
    """Add a flag: does any row of the key meet the condition? All rows without a key are one group."""
    marked = df.where(condition).select(key).distinct().withColumn(name, F.lit(True))
    joined = even_join(df, marked, key, "left", null_safe=True)
    return joined.withColumn(name, F.coalesce(name, F.lit(False)))


def net_equals(df: DataFrame, key: str, negative: Column, value: int = 1) -> DataFrame:
    """Keep the rows of groups whose +1/-1 sum is ``value``. All rows without a key are one group."""
    step = F.when(negative, -1).otherwise(1)
    chosen = df.groupBy(key).agg(F.sum(step).alias("_net")).where(F.col("_net") == value).select(key)
    return even_join(df, chosen, key, "left_semi", null_safe=True)
