"""The provided tables in the roles the marts read.

Orders stand for the ledger of a creator platform, line items for payments, customers for users, suppliers for
channels, parts for packages and products, events for follows, direct payments and analytics events, documents for
posts. ``ROLES`` states the same in SQL for the comparison runs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import cache, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog import table
from ledgerloom.plans.registry import Context

PARAMS = {
    "page_base": "https://example.com/@",
    "product_prefix": "com.example.android.",
    "internal_account": "internal_%",
    "internal_user": "internal%",
    "keywords": ("the", "que", "und"),
    "tier_scale": 30000.0,
    "product_kind": "promo",
    "campaign": "push_spring",
    "campaign_since": "2024-01-06",
}


def cents(price: str) -> Column:
    return F.round(F.col(price) * 100).cast("bigint")


def account_name() -> Column:
    prefix = F.when(F.col("o_orderpriority") == "1-URGENT", "internal_").otherwise("user")
    return F.concat(prefix, F.col("o_custkey").cast("string"))


def user_account(t) -> DataFrame:
    return t("customer").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit("user"), F.col("c_custkey").cast("string")).alias("username"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")).alias("alias"),
        F.col("c_custkey").cast("string").alias("prev_alias"),
        F.col("c_name").alias("display_name"),
        F.col("c_nationkey").cast("string").alias("country"),
        F.when(F.col("c_acctbal") < 0, 1).when(F.col("c_acctbal") < 5000, 0).alias("auto_follow"),
    )


def country(t) -> DataFrame:
    return t("nation").select(F.col("n_nationkey").cast("string").alias("alpha_2"), F.col("n_name").alias("name"))


def channel(t) -> DataFrame:
    return t("supplier").select(
        F.col("s_suppkey").alias("id"),
        F.floor(F.col("s_suppkey") / 2).cast("bigint").alias("owner_id"),
        F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit("-"))).alias("slug"),
    )


def transfer_permission(t) -> DataFrame:
    return t("supplier").select(F.col("s_suppkey").alias("user_id"), (F.col("s_acctbal") > 0).alias("is_allowed"))


def post(t) -> DataFrame:
    return t("documents").select(F.expr("substr(source, 4)").cast("bigint").alias("owner_id"), "text")


def billing_ledger(t) -> DataFrame:
    status = F.col("o_orderstatus")
    sender = F.floor(F.col("o_totalprice") / 350).cast("string")
    return t("orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("created_at"),
        account_name().alias("user_id"),
        F.when(status == "F", "top_up").when(status == "O", "transfer_inbound").otherwise("consumption").alias("type"),
        (cents("o_totalprice") * F.when(status == "P", -1).otherwise(1)).alias("amount"),
        F.when(status == "O", F.concat(F.lit('{"sender_alias": "'), sender, F.lit('"}')))
        .otherwise(F.lit('{"note": null}'))
        .alias("metadata"),
        F.when(status == "F", F.col("o_orderkey")).alias("paymee_order_id"),
        F.when(status == "P", F.col("o_orderkey")).alias("order_id"),
    )


def checkout(t) -> DataFrame:
    priority = F.col("o_orderpriority")
    line = F.concat(F.lit('[{"conversion_package_slug": "line-'), F.col("o_custkey").cast("string"), F.lit('"}]'))
    return (
        t("orders")
        .where("o_orderstatus = 'F'")
        .select(
            F.col("o_orderkey").alias("id"),
            account_name().alias("user_id"),
            F.when(priority == "5-LOW", "PENDING").otherwise("COMPLETED").alias("status"),
            F.when(F.col("o_totalprice") < 20000, "gift").otherwise("star").alias("type"),
            F.when(priority != "2-HIGH", F.col("o_totalprice") > 480000).alias("is_test_purchase"),
            F.when(priority == "4-NOT SPECIFIED", 0)
            .when(priority != "3-MEDIUM", F.round(F.col("o_totalprice")))
            .cast("bigint")
            .alias("top_up_quantity"),
            F.when(priority.isin("1-URGENT", "3-MEDIUM"), line).otherwise(F.lit("[]")).alias("lines"),
        )
    )


def payment(t) -> DataFrame:
    number = F.col("l_linenumber")
    return t("lineitem").select(
        F.col("l_orderkey").alias("checkout_id"),
        F.when(number == 1, "appstore")
        .when(number == 2, "google_play")
        .when(number == 3, "gw.bank_transfer")
        .when(number == 4, "gw.internal.tether")
        .otherwise("card")
        .alias("gateway"),
        F.when(F.col("l_returnflag") == "R", "REFUNDED")
        .when((F.col("l_returnflag") == "A") | (F.col("l_linestatus") == "O"), "CHARGED")
        .otherwise("FAILED")
        .alias("charge_status"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_shipdate").alias("updated_at"),
        F.struct(
            F.concat(F.lit("com.example.android."), F.col("l_partkey").cast("string")).alias("productId")
        ).alias("gateway_response"),
    )


def conversion_package(t) -> DataFrame:
    return t("part").select(F.col("p_partkey").alias("id"), F.concat_ws("/", "p_brand", "p_name").alias("slug"))


def direct_event(t) -> DataFrame:
    kind = F.col("event_type")
    return t("events").select(
        F.to_date("ts").alias("transaction_date"),
        "user_id",
        F.when(kind == "purchase", "stripe").when(kind == "signup", "donation_direct").otherwise(kind).alias("product_type"),
        F.col("event_id").cast("string").alias("consum_transaction_id"),
        F.col("value").alias("usd_amount"),
    )


def user_master(t) -> DataFrame:
    balance = F.col("c_acctbal")
    return t("customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("user_alias"),
        F.when(balance < -500, F.lit("2001-01-31").cast("date")).alias("suspended_at"),
        F.when(balance < -500, "debt").alias("suspend_reason"),
        F.col("c_nationkey").cast("string").alias("country"),
        F.concat(F.lower("c_mktsegment"), F.lit(".example")).alias("email_domain"),
        F.lit("mail").alias("provider"),
        F.when(balance > 5000, "ios").otherwise("android").alias("preferred_os_system"),
        (balance < -800).alias("is_suspicious_user"),
        F.when(balance < 3000, balance < -700).alias("is_sus_social"),
        F.when(balance > 0, balance > 9000).alias("is_suspicious_x_social"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("analytics_user_contry_code"),
    )


def allow_list(t) -> DataFrame:
    return t("supplier").select(F.when(F.col("s_acctbal") > 0, F.col("s_suppkey")).alias("alias"))


def channel_follow(t) -> DataFrame:
    return t("events").select(
        F.get_json_object("props", "$.k").cast("bigint").alias("channel_id"),
        F.col("user_id").alias("follower_id"),
        F.col("ts").alias("created_at"),
    )


def ecom_order(t) -> DataFrame:
    return t("lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit("E"), F.col("l_linenumber").cast("string"))).alias("event_code"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("billing_transaction_id"),
    )


def ecom_product(t) -> DataFrame:
    return t("part").select(
        F.col("p_partkey").alias("id"), F.lower("p_type").alias("type"), F.col("p_brand").alias("subtype")
    )


def revenue_transaction(t) -> DataFrame:
    return t("supplier").select(
        F.col("s_suppkey").alias("id"),
        F.concat(F.lit("REV-"), F.col("s_suppkey").cast("string")).alias("event_code"),
        F.concat(F.lit("user"), F.col("s_suppkey").cast("string")).alias("user_id"),
    )


def analytics_event(t) -> DataFrame:
    user = F.col("user_id").cast("string")
    properties = F.concat(
        F.lit('{"$os": "'),
        F.col("event_type"),
        F.lit('", "utm_campaign": "'),
        F.when(F.col("value") > 20, "apk_push_spring").otherwise("none"),
        F.lit('", "$browser": '),
        F.get_json_object("props", "$.k"),
        F.lit(', "$ip": null, "$device": {"model": "m1"}, "distinct_id": "u'),
        user,
        F.lit('"}'),
    )
    return t("events").select(
        F.concat(F.lit("u"), user).alias("distinct_id"),
        F.col("ts").alias("created_at"),
        F.col("event_type").alias("event"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("uuid"),
        properties.alias("properties"),
        F.concat(F.lit("s"), user).alias("$session_id"),
        F.concat(F.lit("w"), user).alias("$window_id"),
        F.concat(F.lit("su"), user).alias("$session_id_uuid"),
        F.lit("full").alias("person_mode"),
    )


def copied_table(t) -> DataFrame:
    return t("orders").select(
        F.col("o_custkey").alias("creator_id"),
        F.date_format("o_orderdate", "yyyy").cast("int").alias("ingest_cycle"),
        F.col("o_orderdate").alias("ingest_at"),
        F.col("o_orderkey").alias("payout_id"),
        cents("o_totalprice").alias("amount"),
    )


def sliced_table(t) -> DataFrame:
    return t("events").select("event_id", F.col("ts").alias("created_at"), "user_id", "event_type", "value")


BUILDERS = {
    build.__name__: build
    for build in (
        user_account,
        country,
        channel,
        transfer_permission,
        post,
        billing_ledger,
        checkout,
        payment,
        conversion_package,
        direct_event,
        user_master,
        allow_list,
        channel_follow,
        ecom_order,
        ecom_product,
        revenue_transaction,
        analytics_event,
        copied_table,
        sliced_table,
    )
}


class RoleTables(Mapping):
    """Role name to frame; a frame is made when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.read = cache(partial(table, spark, folder))
        self.make = cache(lambda build: build(self.read))

    def __getitem__(self, name: str) -> DataFrame:
        return self.make(BUILDERS[name])

    def __iter__(self):
        return iter(BUILDERS)

    def __len__(self):
        return len(BUILDERS)


def context(
    spark: SparkSession, folder: str, as_of: dt.date, database: str | None = None, **params: object
) -> Context:
    return Context(spark, RoleTables(spark, folder), as_of, {**PARAMS, **params}, database)


ROLES = """
WITH user_account AS (
  SELECT c_custkey AS id, 'user' || c_custkey AS username,
    CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS alias,
    CAST(c_custkey AS VARCHAR) AS prev_alias, c_name AS display_name, CAST(c_nationkey AS VARCHAR) AS country,
    CASE WHEN c_acctbal < 0 THEN 1 WHEN c_acctbal < 5000 THEN 0 END AS auto_follow
  FROM customer
), country AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS alpha_2, n_name AS name FROM nation
), channel AS (
  SELECT s_suppkey AS id, s_suppkey // 2 AS owner_id, lower(replace(s_name, '#', '-')) AS slug FROM supplier
), transfer_permission AS (
  SELECT s_suppkey AS user_id, s_acctbal > 0 AS is_allowed FROM supplier
), post AS (
  SELECT CAST(substr(source, 4) AS BIGINT) AS owner_id, text FROM documents
), billing_ledger AS (
  SELECT o_orderkey AS id, o_orderdate AS created_at,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'internal_' ELSE 'user' END || o_custkey AS user_id,
    CASE o_orderstatus WHEN 'F' THEN 'top_up' WHEN 'O' THEN 'transfer_inbound' ELSE 'consumption' END AS type,
    CAST(round(o_totalprice * 100) AS BIGINT) * CASE WHEN o_orderstatus = 'P' THEN -1 ELSE 1 END AS amount,
    CASE WHEN o_orderstatus = 'O'
      THEN '{"sender_alias": "' || CAST(floor(o_totalprice / 350) AS BIGINT) || '"}'
      ELSE '{"note": null}' END AS metadata,
    CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS paymee_order_id,
    CASE WHEN o_orderstatus = 'P' THEN o_orderkey END AS order_id
  FROM orders
), checkout AS (
  SELECT o_orderkey AS id,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'internal_' ELSE 'user' END || o_custkey AS user_id,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'PENDING' ELSE 'COMPLETED' END AS status,
    CASE WHEN o_totalprice < 20000 THEN 'gift' ELSE 'star' END AS type,
    CASE WHEN o_orderpriority <> '2-HIGH' THEN o_totalprice > 480000 END AS is_test_purchase,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 0
      WHEN o_orderpriority <> '3-MEDIUM' THEN CAST(round(o_totalprice) AS BIGINT) END AS top_up_quantity,
    CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM')
      THEN '[{"conversion_package_slug": "line-' || o_custkey || '"}]' ELSE '[]' END AS lines
  FROM orders WHERE o_orderstatus = 'F'
), payment AS (
  SELECT l_orderkey AS checkout_id,
    CASE l_linenumber WHEN 1 THEN 'appstore' WHEN 2 THEN 'google_play' WHEN 3 THEN 'gw.bank_transfer'
      WHEN 4 THEN 'gw.internal.tether' ELSE 'card' END AS gateway,
    CASE WHEN l_returnflag = 'R' THEN 'REFUNDED' WHEN l_returnflag = 'A' OR l_linestatus = 'O' THEN 'CHARGED'
      ELSE 'FAILED' END AS charge_status,
    l_extendedprice AS amount, l_shipdate AS updated_at,
    '{"productId": "com.example.android.' || l_partkey || '"}' AS gateway_response
  FROM lineitem
), conversion_package AS (
  SELECT p_partkey AS id, p_brand || '/' || p_name AS slug FROM part
), direct_event AS (
  SELECT CAST(ts AS DATE) AS transaction_date, user_id,
    CASE event_type WHEN 'purchase' THEN 'stripe' WHEN 'signup' THEN 'donation_direct' ELSE event_type END AS product_type,
    CAST(event_id AS VARCHAR) AS consum_transaction_id, value AS usd_amount
  FROM events
), user_master AS (
  SELECT c_custkey AS user_id, c_name AS user_alias,
    CASE WHEN c_acctbal < -500 THEN DATE '2001-01-31' END AS suspended_at,
    CASE WHEN c_acctbal < -500 THEN 'debt' END AS suspend_reason,
    CAST(c_nationkey AS VARCHAR) AS country, lower(c_mktsegment) || '.example' AS email_domain, 'mail' AS provider,
    CASE WHEN c_acctbal > 5000 THEN 'ios' ELSE 'android' END AS preferred_os_system,
    c_acctbal < -800 AS is_suspicious_user,
    CASE WHEN c_acctbal < 3000 THEN c_acctbal < -700 END AS is_sus_social,
    CASE WHEN c_acctbal > 0 THEN c_acctbal > 9000 END AS is_suspicious_x_social,
    'N' || c_nationkey AS analytics_user_contry_code
  FROM customer
), allow_list AS (
  SELECT CASE WHEN s_acctbal > 0 THEN s_suppkey END AS alias FROM supplier
), channel_follow AS (
  SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS channel_id, user_id AS follower_id, ts AS created_at
  FROM events
), ecom_order AS (
  SELECT l_orderkey AS id, CASE WHEN l_linestatus = 'O' THEN 'E' || l_linenumber END AS event_code,
    l_partkey AS product_id, l_suppkey AS billing_transaction_id
  FROM lineitem
), ecom_product AS (
  SELECT p_partkey AS id, lower(p_type) AS type, p_brand AS subtype FROM part
), revenue_transaction AS (
  SELECT s_suppkey AS id, 'REV-' || s_suppkey AS event_code, 'user' || s_suppkey AS user_id FROM supplier
), analytics_event AS (
  SELECT 'u' || user_id AS distinct_id, ts AS created_at, event_type AS event, 'e' || event_id AS uuid,
    '{"$os": "' || event_type || '", "utm_campaign": "'
      || CASE WHEN value > 20 THEN 'apk_push_spring' ELSE 'none' END || '", "$browser": '
      || json_extract_string(props, '$.k') || ', "$ip": null, "$device": {"model": "m1"}, "distinct_id": "u'
      || user_id || '"}' AS properties,
    's' || user_id AS "$session_id", 'w' || user_id AS "$window_id", 'su' || user_id AS "$session_id_uuid",
    'full' AS person_mode
  FROM events
), copied_table AS (
  SELECT o_custkey AS creator_id, CAST(year(o_orderdate) AS INTEGER) AS ingest_cycle, o_orderdate AS ingest_at,
    o_orderkey AS payout_id, CAST(round(o_totalprice * 100) AS BIGINT) AS amount
  FROM orders
), sliced_table AS (
  SELECT event_id, ts AS created_at, user_id, event_type, value FROM events
)
"""
