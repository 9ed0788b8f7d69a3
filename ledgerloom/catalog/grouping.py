"""Aggregations and windows (A and W rows of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog import query, table
from ledgerloom.catalog.roles import cents
from ledgerloom.functions.dates import month_start
from ledgerloom.operators.aggregates import agg_all, distinct_values, duplicates, waterfall
from ledgerloom.operators.windows import any_in_group, latest_per_key, net_equals


@query(
    "a01_group_by_all",
    """
SELECT o_custkey AS user_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS date_key,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) / 100 AS usd_amount, count(*) AS n
FROM orders GROUP BY ALL
""",
)
def group_by_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg_all(
        table(spark, sf_dir, "orders"),
        {"user_id": F.col("o_custkey"), "date_key": month_start(F.col("o_orderdate"))},
        {"usd_amount": F.sum(cents("o_totalprice")) / 100, "n": F.count(F.lit(1))},
    )


@query(
    "a02_sum_in_other_unit",
    "SELECT l_suppkey, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) / -100 AS usd FROM lineitem GROUP BY ALL",
)
def other_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg((F.sum(cents("l_extendedprice")) / -100).alias("usd"))


@query(
    "a03_count_distinct",
    """
SELECT o_custkey, count(DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END) AS priorities,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM orders GROUP BY ALL
""",
)
def distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.countDistinct(priority).alias("priorities"), F.sum(cents("o_totalprice")).alias("total_cents"))
    )


@query(
    "a04_min_max",
    """
SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_at, max(CAST(o_orderdate AS DATE)) AS last_at,
  max(o_orderpriority) AS max_label, min(o_orderpriority) AS min_label
FROM orders GROUP BY ALL
""",
)
def min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.min(day).alias("first_at"),
            F.max(day).alias("last_at"),
            F.max("o_orderpriority").alias("max_label"),
            F.min("o_orderpriority").alias("min_label"),
        )
    )


@query("a05_any", "SELECT user_id, max(event_type = 'error') AS had_error FROM events GROUP BY ALL")
def any_true(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.bool_or(F.col("event_type") == "error").alias("had_error"))


@query("a06_distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query(
    "a07_conditional_sum",
    "SELECT l_orderkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS refunds FROM lineitem GROUP BY ALL",
)
def conditional_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    refund = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum(refund).alias("refunds"))


@query("a08_duplicates", "SELECT p_name, count(*) AS n FROM part GROUP BY ALL HAVING count(*) > 1")
def duplicate_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates(table(spark, sf_dir, "part"), ["p_name"])


@query(
    "a09_waterfall",
    """
WITH s AS (SELECT CAST(sum(CAST(l_quantity AS DECIMAL(38,6))) AS DECIMAL(38,6)) AS q,
  CAST(sum(CAST(l_discount AS DECIMAL(38,6))) AS DECIMAL(38,6)) AS d, CAST(sum(CAST(l_tax AS DECIMAL(38,6))) AS DECIMAL(38,6)) AS t FROM lineitem)
SELECT CAST(0 AS INTEGER) AS position, 'l_quantity' AS measure, CAST(round(q, 2) AS DOUBLE) AS amount, 'relative' AS kind FROM s
UNION ALL SELECT 1, 'l_discount', CAST(round(d, 2) AS DOUBLE), 'relative' FROM s
UNION ALL SELECT 2, 'l_tax', CAST(round(t, 2) AS DOUBLE), 'relative' FROM s
UNION ALL SELECT 3, 'total', CAST(round(q + d + t, 2) AS DOUBLE), 'total' FROM s
""",
)
def subtotal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return waterfall(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "total")


@query("a10_distinct_values", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders")
def distinct_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")), "day")


@query(
    "w01_latest_per_key",
    """
SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1
""",
)
def latest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_orderkey")


@query(
    "w01_latest_per_two_keys",
    """
SELECT event_id, user_id, event_type, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1
""",
)
def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return latest_per_key(events, ["user_id", "event_type"], "ts", "event_id")


REFUND_KEY = "CASE WHEN l_linestatus = 'F' THEN l_orderkey END"


@query(
    "w02_refund_flag",
    f"""
SELECT l_orderkey, l_linenumber, l_partkey,
  sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) OVER (PARTITION BY checkout_id) <> 0 AS is_refunded
FROM (SELECT *, {REFUND_KEY} AS checkout_id FROM lineitem)
""",
)
def refund_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_returnflag",
        F.when(F.col("l_linestatus") == "F", F.col("l_orderkey")).alias("checkout_id"),
    )
    flagged = any_in_group(lines, "checkout_id", F.col("l_returnflag") == "R", "is_refunded")
    return flagged.drop("l_returnflag", "checkout_id")


@query(
    "w03_net_one",
    """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
QUALIFY sum(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END) OVER (PARTITION BY l_orderkey) = 1
""",
)
def net_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return net_equals(lines, "l_orderkey", F.col("l_returnflag") == "R", 1).drop("l_returnflag")
