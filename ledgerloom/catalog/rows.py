"""Filters, limits and set operations (F, L and U rows of the inventory)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.catalog import query, table
from ledgerloom.operators.filters import date_slice, qualify, recent, without_unnamed
from ledgerloom.operators.sets import anti, semi, stack_frames, sym_diff, union_all, union_new


@query(
    "f01_conjunction",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'A' AND l_quantity < 10 AND l_shipdate >= DATE '1998-01-01'",
)
def conjunction(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem")
    kept = (F.col("l_returnflag") == "A") & (F.col("l_quantity") < 10) & (F.col("l_shipdate") >= F.lit(dt.date(1998, 1, 1)))
    return df.where(kept).select("l_orderkey", "l_linenumber")


@query("f02_in_list", "SELECT * FROM part WHERE p_type IN ('PROMO', 'SMALL')")
def in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").where(F.col("p_type").isin("PROMO", "SMALL"))


@query(
    "f03_like",
    "SELECT c_custkey, c_name LIKE 'Customer_00000000%' AS wild, c_name NOT LIKE '%7' AS not_seven FROM customer "
    "WHERE c_name LIKE 'Customer_0%'",
)
def like(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("c_name")
    return (
        table(spark, sf_dir, "customer")
        .where(name.like("Customer_0%"))
        .select("c_custkey", name.like("Customer_00000000%").alias("wild"), (~name.like("%7")).alias("not_seven"))
    )


@query(
    "f04_not_both",
    """
SELECT o_orderkey, o_orderstatus FROM (
  SELECT *, CASE WHEN o_totalprice > 100000 THEN o_custkey END AS seller_alias FROM orders)
WHERE NOT (o_orderstatus = 'O' AND seller_alias IS NULL)
""",
)
def not_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "orders").withColumn("seller_alias", F.when(F.col("o_totalprice") > 100000, F.col("o_custkey")))
    return without_unnamed(named, "o_orderstatus", "O", "seller_alias").select("o_orderkey", "o_orderstatus")


@query(
    "f05_null_tests",
    """
SELECT o.o_orderkey, l.l_orderkey IS NULL AS unpaid FROM orders AS o
LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 45) AS l ON l.l_orderkey = o.o_orderkey
WHERE o.o_custkey IS NOT NULL
""",
)
def null_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select("l_orderkey").distinct()
    orders = table(spark, sf_dir, "orders").where(F.col("o_custkey").isNotNull())
    joined = orders.join(paid, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select("o_orderkey", F.col("l_orderkey").isNull().alias("unpaid"))


@query(
    "f06_date_slice",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1998-02-01' AND CAST(o_orderdate AS DATE) < DATE '1998-03-01'",
)
def sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return date_slice(orders, "o_orderdate", "1998-02-01", "1998-03-01")


@query(
    "f07_recency",
    """
SELECT 'month' AS rule, event_id FROM events WHERE ts >= TIMESTAMP '2024-02-20' - INTERVAL 1 MONTH
UNION ALL SELECT 'day', event_id FROM events WHERE ts >= DATE '2024-01-30' - 1
UNION ALL SELECT 'three days', event_id FROM events WHERE ts >= DATE '2024-01-30' - 3
UNION ALL SELECT 'two whole months', event_id FROM events WHERE ts >= DATE '2024-01-01'
""",
)
def recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    end = dt.date(2024, 1, 30)
    rules = {
        "month": recent(events, "ts", dt.date(2024, 2, 20), 1, "months"),
        "day": recent(events, "ts", end, 1, "days"),
        "three days": recent(events, "ts", end, 3, "days"),
        "two whole months": recent(events, "ts", dt.date(2024, 3, 15), 2, "whole_months"),
    }
    return stack_frames(*[df.select(F.lit(name).alias("rule"), "event_id") for name, df in rules.items()])


@query(
    "f09_qualify",
    "SELECT o_orderkey, o_custkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) <= 2",
)
def qualified(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.col("o_orderdate").desc(), "o_orderkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return qualify(orders, place, lambda rn: rn <= 2).drop("o_orderdate")


@query(
    "f10_null_default",
    """
SELECT o_orderkey FROM (SELECT o_orderkey, CASE WHEN o_orderpriority <> '2-HIGH' THEN o_totalprice > 400000 END AS is_test FROM orders)
WHERE coalesce(is_test, false) = false
""",
)
def null_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_test = F.when(F.col("o_orderpriority") != "2-HIGH", F.col("o_totalprice") > 400000)
    return table(spark, sf_dir, "orders").where(~F.coalesce(is_test, F.lit(False))).select("o_orderkey")


@query("f11_always_true", "SELECT n_name FROM nation WHERE true")
def always_true(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").where(F.lit(True)).select("n_name")


@query("l01_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(25)


@query(
    "u01_union_all",
    """
SELECT CAST(o_orderdate AS DATE) AS date_key, o_custkey AS user_id, CAST(o_orderkey AS VARCHAR) AS transaction_id,
  CAST(round(o_totalprice * 100) AS BIGINT) / 100 AS usd_amount FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT CAST(ts AS DATE), user_id, CAST(event_id AS VARCHAR), value FROM events WHERE event_type = 'purchase'
UNION ALL
SELECT CAST(ts AS DATE), CAST(user_id AS INTEGER), event_type, CAST(1 AS INTEGER) FROM events WHERE event_type = 'signup'
""",
)
def unionized(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, events = table(spark, sf_dir, "orders"), table(spark, sf_dir, "events")
    usd = F.round(F.col("o_totalprice") * 100).cast("bigint") / 100
    return union_all(
        orders.where("o_orderstatus = 'F'").select(
            F.to_date("o_orderdate").alias("date_key"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderkey").cast("string").alias("transaction_id"),
            usd.alias("usd_amount"),
        ),
        events.where("event_type = 'purchase'").select(
            F.to_date("ts"), "user_id", F.col("event_id").cast("string"), "value"
        ),
        events.where("event_type = 'signup'").select(F.to_date("ts"), F.col("user_id").cast("int"), "event_type", F.lit(1)),
    )


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All orders in two halves with a row per order; in the second, every third order has a buyer unknown to the first."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"), "o_orderkey")
    a = orders.where("o_orderkey % 2 = 0")
    b = orders.where("o_orderkey % 2 = 1").withColumn("user_id", F.when(F.col("o_orderkey") % 3 == 0, -F.col("user_id")).otherwise(F.col("user_id")))
    return a, b


HALVES = """
WITH a AS (SELECT o_custkey AS user_id, o_orderkey FROM orders WHERE o_orderkey % 2 = 0),
b AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN -o_custkey ELSE o_custkey END AS user_id, o_orderkey FROM orders WHERE o_orderkey % 2 = 1)
"""


@query("u02_union_new", HALVES + "SELECT * FROM a UNION ALL SELECT * FROM b WHERE user_id NOT IN (SELECT user_id FROM a)")
def full_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_new(*_halves(spark, sf_dir), "user_id")


@query("u03_intersection", HALVES + "SELECT * FROM b WHERE user_id IN (SELECT user_id FROM a)")
def intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _halves(spark, sf_dir)
    return semi(b, a, "user_id")


@query("u04_difference", HALVES + "SELECT * FROM b WHERE user_id NOT IN (SELECT user_id FROM a)")
def difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _halves(spark, sf_dir)
    return anti(b, a, "user_id")


@query(
    "u05_symmetric_difference",
    HALVES
    + "SELECT * FROM a WHERE user_id NOT IN (SELECT user_id FROM b) UNION ALL "
    + "SELECT * FROM b WHERE user_id NOT IN (SELECT user_id FROM a)",
)
def symmetric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sym_diff(*_halves(spark, sf_dir), "user_id")


@query(
    "u06_stack",
    """
SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, CAST(NULL AS BIGINT) AS s_suppkey FROM customer
UNION ALL SELECT s_name, s_nationkey, NULL, s_suppkey FROM supplier
""",
)
def stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), "s_suppkey"
    )
    return stack_frames(customers, suppliers)
