"""Joins (J rows of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog import query, table
from ledgerloom.catalog.roles import ROLES, context
from ledgerloom.catalog.marts import EVENTS_AS_OF
from ledgerloom.functions.dates import month_start
from ledgerloom.functions.jsonpath import json_scalar
from ledgerloom.operators.joins import anti_before_first, even_join, rejoin_totals, spread_join


@query(
    "j01_left",
    "SELECT c.c_custkey, o.o_orderkey FROM customer AS c LEFT JOIN orders AS o ON c.c_custkey = o.o_custkey",
)
def left(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return spread_join(customers, orders, "c_custkey", "left", hot="both")


@query(
    "j02_inner",
    "SELECT l.l_orderkey, l.l_linenumber, o.o_custkey FROM lineitem AS l JOIN orders AS o ON l.l_orderkey = o.o_orderkey",
)
def inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return lines.join(orders, "l_orderkey", "inner").select("l_orderkey", "l_linenumber", "o_custkey")


@query(
    "j03_full_one_key",
    """
SELECT coalesce(a.k, b.k) AS user_id, a.n AS orders, b.n AS events
FROM (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) AS a
FULL JOIN (SELECT user_id AS k, count(*) AS n FROM events GROUP BY 1) AS b ON a.k = b.k
""",
)
def full_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    a = orders.groupBy(F.col("o_custkey").alias("user_id")).agg(F.count(F.lit(1)).alias("orders"))
    b = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))
    return a.join(b, "user_id", "full")


@query(
    "j04_full_three_keys",
    """
WITH e AS (SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day, ts FROM events)
SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.event_type, b.event_type) AS event_type,
  coalesce(a.day, b.day) AS day, a.n AS early, b.n AS late
FROM (SELECT user_id, event_type, day, count(*) AS n FROM e WHERE ts < TIMESTAMP '2024-01-20 12:00:00' GROUP BY ALL) AS a
FULL JOIN (SELECT user_id, event_type, day, count(*) AS n FROM e WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' GROUP BY ALL) AS b
  ON a.user_id = b.user_id AND a.event_type = b.event_type AND a.day = b.day
""",
)
def full_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["user_id", "event_type", "day"]
    events = table(spark, sf_dir, "events").select("user_id", "event_type", F.to_date("ts").alias("day"), "ts").distinct()
    noon = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    a = events.where(F.col("ts") < noon).groupBy(*keys).agg(F.count(F.lit(1)).alias("early"))
    b = events.where(F.col("ts") >= noon).groupBy(*keys).agg(F.count(F.lit(1)).alias("late"))
    return a.join(b, keys, "full")


@query(
    "j05_anti_before_first",
    """
SELECT p.event_id, p.user_id, p.ts FROM events AS p
LEFT JOIN (SELECT user_id, min(ts) AS first_ts FROM events WHERE event_type = 'signup' GROUP BY ALL) AS f
  ON p.user_id = f.user_id AND p.ts < f.first_ts
WHERE p.event_type = 'purchase' AND f.user_id IS NULL
""",
)
def anti_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    firsts = events.where("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("first_ts"))
    return anti_before_first(purchases, firsts, "user_id", "user_id", "ts", "first_ts")


@query(
    "j06_coalesced_key",
    """
SELECT s.s_suppkey, c.c_custkey FROM supplier AS s
JOIN (SELECT c_custkey, coalesce(CAST(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS VARCHAR), CAST(c_nationkey AS VARCHAR)) AS k FROM customer) AS c
  ON CAST(s.s_suppkey AS VARCHAR) = c.k
""",
)
def coalesced_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    alias = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")).cast("string")
    users = table(spark, sf_dir, "customer").select("c_custkey", F.coalesce(alias, F.col("c_nationkey").cast("string")).alias("_k"))
    listed = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("_k"), "s_suppkey")
    return users.join(listed, "_k", "inner").select("s_suppkey", "c_custkey")


@query(
    "j07_json_key",
    ROLES
    + """
SELECT l.id, u.id AS seller_id FROM billing_ledger AS l
JOIN user_account AS u ON json_extract_string(l.metadata, '$.sender_alias') = u.prev_alias
""",
)
def json_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = context(spark, sf_dir, EVENTS_AS_OF)
    ledger = ctx.source("billing_ledger").select("id", json_scalar(F.col("metadata"), "$.sender_alias").alias("_k"))
    users = ctx.source("user_account").select(F.col("prev_alias").alias("_k"), F.col("id").alias("seller_id"))
    return ledger.join(users, "_k", "inner").drop("_k")


@query(
    "j08_month_and_id",
    """
SELECT o.o_orderkey, m.n FROM orders AS o
LEFT JOIN (SELECT user_id, CAST(date_trunc('month', ts) AS DATE) AS m, count(*) AS n FROM events GROUP BY ALL) AS m
  ON o.o_custkey = m.user_id AND CAST(date_trunc('month', o.o_orderdate + INTERVAL 276 MONTH) AS DATE) = m.m
""",
)
def month_and_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    months = events.groupBy("user_id", month_start(F.col("ts")).alias("_m")).agg(F.count(F.lit(1)).alias("n"))
    shifted = F.add_months(F.to_date("o_orderdate"), 276)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), month_start(shifted).alias("_m"))
    return even_join(orders, months, ["user_id", "_m"], "left").select("o_orderkey", "n")


@query(
    "j09_using",
    "SELECT user_id, o_orderkey, event_count FROM (SELECT o_custkey AS user_id, o_orderkey FROM orders) "
    "LEFT JOIN (SELECT user_id, count(*) AS event_count FROM events GROUP BY 1) USING (user_id)",
)
def using(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"), "o_orderkey")
    events = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("event_count"))
    return even_join(orders, events, "user_id", "left")


@query(
    "j10_two_roles",
    """
SELECT l.l_orderkey, l.l_linenumber, nb.n_name AS buyer_country, ns.n_name AS seller_country
FROM lineitem AS l JOIN orders AS o ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer AS c ON c.c_custkey = o.o_custkey LEFT JOIN supplier AS s ON s.s_suppkey = l.l_suppkey
LEFT JOIN nation AS nb ON nb.n_nationkey = c.c_nationkey LEFT JOIN nation AS ns ON ns.n_nationkey = s.s_nationkey
""",
)
def two_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")

    def country(role: str, key: str) -> DataFrame:
        return nation.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(f"{role}_country"))

    buyers = table(spark, sf_dir, "customer").join(country("buyer", "c_nationkey"), "c_nationkey", "left")
    buyers = buyers.select(F.col("c_custkey").alias("o_custkey"), "buyer_country")
    sellers = table(spark, sf_dir, "supplier").join(country("seller", "s_nationkey"), "s_nationkey", "left")
    sellers = sellers.select(F.col("s_suppkey").alias("l_suppkey"), "seller_country")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    bought = orders.join(buyers, "o_custkey", "left").drop("o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    sold = lines.join(sellers, "l_suppkey", "left")
    joined = sold.join(bought, "l_orderkey", "inner")
    return joined.select("l_orderkey", "l_linenumber", "buyer_country", "seller_country")


@query(
    "j11_star",
    """
SELECT l.l_orderkey, l.l_linenumber, p.p_brand, s.s_name, c.c_name, n.n_name, r.r_name
FROM lineitem AS l LEFT JOIN part AS p ON p.p_partkey = l.l_partkey LEFT JOIN supplier AS s ON s.s_suppkey = l.l_suppkey
LEFT JOIN orders AS o ON o.o_orderkey = l.l_orderkey LEFT JOIN customer AS c ON c.c_custkey = o.o_custkey
LEFT JOIN nation AS n ON n.n_nationkey = c.c_nationkey LEFT JOIN region AS r ON r.r_regionkey = n.n_regionkey
""",
)
def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimensions that hang on the customer are joined to each other first; the lines are shuffled once per own key."""
    region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    nation = table(spark, sf_dir, "nation").join(region, "n_regionkey", "left").withColumnRenamed("n_nationkey", "c_nationkey")
    customer = table(spark, sf_dir, "customer").join(nation, "c_nationkey", "left")
    customer = customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "n_name", "r_name")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    orders = orders.join(customer, "o_custkey", "left").drop("o_custkey")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    wide = lines.join(part, "l_partkey", "left")
    wide = wide.join(supplier, "l_suppkey", "left").join(orders, "l_orderkey", "left")
    return wide.drop("l_partkey", "l_suppkey")


@query(
    "j12_left_made_inner",
    "SELECT l.l_orderkey, l.l_linenumber FROM lineitem AS l LEFT JOIN part AS p ON p.p_partkey = l.l_partkey WHERE p.p_type = 'PROMO'",
)
def left_made_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lines.join(part, "l_partkey", "left").where("p_type = 'PROMO'").select("l_orderkey", "l_linenumber")


@query(
    "j13_fan_out",
    """
SELECT o.o_orderkey, l.l_returnflag, count(*) AS payments FROM orders AS o
LEFT JOIN lineitem AS l ON l.l_orderkey = o.o_orderkey GROUP BY ALL
""",
)
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_returnflag", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    joined = spread_join(orders, lines, "o_orderkey", "left", hot="right")
    return joined.groupBy("o_orderkey", "l_returnflag").agg(F.count(F.lit(1)).alias("payments"))


@query(
    "j14_rejoined_totals",
    """
SELECT e.event_id, e.user_id, t.event_types, t.n FROM events AS e
LEFT JOIN (SELECT user_id, count(DISTINCT event_type) AS event_types, count(*) AS n FROM events GROUP BY 1) AS t
  ON e.user_id = t.user_id
""",
)
def rejoined(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    joined = rejoin_totals(events, ["user_id"], event_types=F.countDistinct("event_type"), n=F.count(F.lit(1)))
    return joined.drop("event_type")
