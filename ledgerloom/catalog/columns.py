"""Projections and conditional columns (P rows of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog import query, table
from ledgerloom.functions.cases import bucket, case_when, flag, null_if, signed_amount, state_changed


@query(
    "p01_projection",
    "SELECT o_orderkey AS transaction_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS purchase_at FROM orders",
)
def projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("purchase_at"),
    )


@query("p02_star_plus", "SELECT *, c_acctbal < 0 AS in_debt FROM customer")
def star_plus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("*", (F.col("c_acctbal") < 0).alias("in_debt"))


@query("p03_star_except", "SELECT * EXCLUDE (props) FROM events")
def star_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").drop("props")


@query(
    "p04_searched_case",
    """
SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'internal_deposit'
  WHEN o_orderstatus IN ('F', 'P') THEN 'iap'
  WHEN o_totalprice > 300000 AND o_orderpriority NOT LIKE '5%' THEN 'for_agency' ELSE 'others' END AS topup_type
FROM orders
""",
)
def searched_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    kind = case_when(
        [
            (priority.like("1%"), F.lit("internal_deposit")),
            (F.col("o_orderstatus").isin("F", "P"), F.lit("iap")),
            ((F.col("o_totalprice") > 300000) & ~priority.like("5%"), F.lit("for_agency")),
        ],
        F.lit("others"),
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", kind.alias("topup_type"))


@query(
    "p05_nested_case",
    """
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'N' AND l_linestatus = 'F' THEN 'as_is'
  ELSE CASE WHEN l_returnflag = 'N' THEN 'insert' ELSE 'update' END END AS operation
FROM lineitem
""",
)
def nested_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    inner = case_when([(F.col("l_returnflag") == "N", F.lit("insert"))], F.lit("update"))
    outer = case_when([((F.col("l_returnflag") != "N") & (F.col("l_linestatus") == "F"), F.lit("as_is"))], inner)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", outer.alias("operation"))


@query(
    "p06_bands",
    """
SELECT c_custkey, CASE WHEN b <= 0 THEN 'N01. debt' WHEN b <= 2500 THEN 'N02. small' WHEN b <= 7500 THEN 'N03. medium'
  WHEN b > 7500 THEN 'N04. large' ELSE 'others' END AS band
FROM (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS b FROM customer)
""",
)
def bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal"))
    labels = ["N01. debt", "N02. small", "N03. medium", "N04. large"]
    return table(spark, sf_dir, "customer").select(
        "c_custkey", bucket(balance, [0.0, 2500.0, 7500.0], labels, "others").alias("band")
    )


@query(
    "p07_coalesce",
    """
SELECT c_custkey, coalesce(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END, -c_nationkey) AS alias,
  coalesce(c_name) AS name
FROM customer
""",
)
def coalesced(spark: SparkSession, sf_dir: str) -> DataFrame:
    alias = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.coalesce(alias, -F.col("c_nationkey")).alias("alias"), F.coalesce("c_name").alias("name")
    )


@query(
    "p08_strict_cast",
    """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(value AS VARCHAR) IS NOT NULL AS has_value,
  TRY_CAST(event_type AS BIGINT) AS lenient
FROM events
""",
)
def strict_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.col("value").cast("string").isNotNull().alias("has_value"),
        F.col("event_type").try_cast("bigint").alias("lenient"),
    )


@query(
    "p09_literals",
    "SELECT o_orderkey, 'topup' AS type, CAST(NULL AS BIGINT) AS seller_id, true AS following_status FROM orders",
)
def literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.lit("topup").alias("type"),
        F.lit(None).cast("bigint").alias("seller_id"),
        F.lit(True).alias("following_status"),
    )


@query(
    "p10_null_if",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS seller_country FROM orders",
)
def nulled(spark: SparkSession, sf_dir: str) -> DataFrame:
    country = null_if(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", country.alias("seller_country"))


@query(
    "p11_signed_amount",
    """
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS amount
FROM lineitem
""",
)
def signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = signed_amount(F.col("l_extendedprice"), F.col("l_returnflag") == "R")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", amount.alias("amount"))


@query(
    "p12_dollar_names",
    """
SELECT event_id, "$session_id" || '/' || "$window_id" AS path, "$session_id"
FROM (SELECT event_id, 's' || user_id AS "$session_id", 'w' || event_type AS "$window_id" FROM events)
""",
)
def dollar_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("$session_id"),
        F.concat(F.lit("w"), F.col("event_type")).alias("$window_id"),
    )
    path = F.concat_ws("/", F.col("`$session_id`"), F.col("`$window_id`"))
    return named.select("event_id", path.alias("path"), F.col("`$session_id`"))


@query(
    "p13_flags",
    """
SELECT c_custkey, coalesce(a AND b, false) AS is_keyword_contains, coalesce(a OR b) AS is_suspicious_social
FROM (SELECT c_custkey, CASE WHEN c_acctbal < 3000 THEN c_acctbal < 0 END AS a,
        CASE WHEN c_acctbal > 1000 THEN c_mktsegment = 'BUILDING' END AS b FROM customer)
""",
)
def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.when(F.col("c_acctbal") < 3000, F.col("c_acctbal") < 0)
    b = F.when(F.col("c_acctbal") > 1000, F.col("c_mktsegment") == "BUILDING")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", flag(a & b).alias("is_keyword_contains"), F.coalesce(a | b).alias("is_suspicious_social")
    )


@query(
    "f08_state_changed",
    """
SELECT c_custkey FROM (SELECT c_custkey, CASE WHEN c_acctbal < 3000 THEN c_acctbal < 0 END AS a,
        CASE WHEN c_acctbal > 1000 THEN c_mktsegment = 'BUILDING' END AS b FROM customer)
WHERE coalesce(a, false) <> coalesce(b, false)
""",
)
def changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.when(F.col("c_acctbal") < 3000, F.col("c_acctbal") < 0)
    b = F.when(F.col("c_acctbal") > 1000, F.col("c_mktsegment") == "BUILDING")
    return table(spark, sf_dir, "customer").where(state_changed(a, b)).select("c_custkey")
