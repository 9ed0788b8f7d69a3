"""Whole marts over the role tables. The SQL joins and windows literally; the builders arrange the same work by key."""

from __future__ import annotations

import datetime as dt
from collections import ChainMap

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import ledgerloom.plans.marts  # noqa: F401  (registers the models)
from ledgerloom.catalog import query
from ledgerloom.catalog.roles import ROLES, context
from ledgerloom.plans.registry import Context, run, run_slice
from ledgerloom.session import scratch_database

PAYERS_AS_OF = dt.date(2001, 11, 15)
ORDERS_AS_OF = dt.date(2001, 7, 30)
EVENTS_AS_OF = dt.date(2024, 1, 31)

STAR_PURCHASE = """, profiles AS (
  SELECT u.id, u.username, coalesce(CAST(u.alias AS VARCHAR), u.prev_alias) AS handle,
    coalesce(u.alias, CAST(u.prev_alias AS BIGINT)) AS alias, u.display_name, u.country, n.name AS country_name,
    'https://example.com/@' || c.slug AS page, coalesce(t.is_allowed, false) AS allowed,
    EXISTS (SELECT 1 FROM post WHERE owner_id = u.id AND regexp_matches(lower(text), '\\b(the|que|und)\\b')) AS wordy
  FROM user_account AS u
  LEFT JOIN channel AS c ON c.owner_id = u.id
  LEFT JOIN transfer_permission AS t ON t.user_id = u.id
  LEFT JOIN country AS n ON n.alpha_2 = u.country
), receipts AS (
  SELECT k.id AS checkout, k.user_id AS payer, k.top_up_quantity, p.gateway, p.charge_status,
    coalesce(json_extract_string(k.lines, '$[0].conversion_package_slug'), g.slug) AS package,
    k.id IN (SELECT checkout_id FROM payment WHERE charge_status = 'REFUNDED') AS refunded
  FROM checkout AS k
  LEFT JOIN payment AS p ON p.checkout_id = k.id
  LEFT JOIN conversion_package AS g ON 'com.example.android.' || g.id = json_extract_string(p.gateway_response, '$.productId')
), star_purchase AS (
  SELECT l.id AS billing_transaction_id, l.type, CAST(l.created_at AS DATE) AS purchase_at, l.created_at AS purchase_time,
    b.id AS buyer_id, b.alias AS buyer_alias, b.display_name AS buyer_display_name, b.page AS buyer_page,
    b.country AS buyer_country, b.country_name AS buyer_country_name, coalesce(b.allowed, false) AS buyer_is_allowed_transfer,
    s.id AS seller_id, s.alias AS seller_alias, s.display_name AS seller_display_name, s.page AS seller_page,
    if(l.type = 'top_up', NULL, s.country) AS seller_country, if(l.type = 'top_up', NULL, s.country_name) AS seller_country_name,
    coalesce(s.allowed, false) AS seller_is_allowed_transfer, coalesce(s.allowed AND s.wordy, false) AS is_keyword_contains,
    r.gateway, r.charge_status, CAST(r.checkout AS VARCHAR) AS checkout_id, r.package AS topup_star_package,
    if(r.charge_status = 'REFUNDED', -1, 1) * l.amount AS amount, coalesce(r.refunded, false) AS is_refunded,
    CASE WHEN starts_with(r.payer, 'internal') AND length(r.payer) > 8 THEN 'internal_deposit'
      WHEN r.gateway IN ('google_play', 'appstore') THEN 'iap'
      WHEN r.payer IS NOT NULL AND r.top_up_quantity IS NOT NULL AND starts_with(r.gateway, 'gw.') THEN 'for_agency'
      WHEN l.type = 'transfer_inbound' THEN l.type ELSE 'others' END AS topup_type
  FROM billing_ledger AS l
  LEFT JOIN receipts AS r ON r.checkout = l.paymee_order_id
  LEFT JOIN profiles AS b ON b.username = l.user_id
  LEFT JOIN profiles AS s ON s.handle = json_extract_string(l.metadata, '$.sender_alias')
  WHERE l.type = 'top_up' OR (l.type = 'transfer_inbound' AND s.alias IS NOT NULL)
)
"""

TOPUP = """, settled AS (
  SELECT checkout_id FROM payment GROUP BY checkout_id
  HAVING count(*) FILTER (charge_status = 'CHARGED') - count(*) FILTER (charge_status = 'REFUNDED') = 1
), user_topup_transaction AS (
  SELECT u.id AS user_id, u.country, CAST(k.id AS VARCHAR) AS id, CAST(NULL AS BIGINT) AS seller_id,
    p.updated_at AS first_purchase_at,
    if(k.top_up_quantity <> 0, CAST(k.top_up_quantity AS DOUBLE), p.amount * 100) AS amount,
    coalesce(json_extract_string(k.lines, '$[0].conversion_package_slug'), g.slug) AS star_package,
    CASE WHEN starts_with(k.user_id, 'internal') AND length(k.user_id) > 8 THEN 'internal_deposit'
      WHEN p.gateway IN ('google_play', 'appstore') THEN 'iap'
      WHEN k.top_up_quantity IS NOT NULL AND starts_with(p.gateway, 'gw.') THEN 'for_agency' ELSE 'others' END AS type
  FROM payment AS p
  JOIN settled USING (checkout_id)
  JOIN checkout AS k ON k.id = p.checkout_id
  LEFT JOIN user_account AS u ON u.username = k.user_id
  LEFT JOIN conversion_package AS g ON 'com.example.android.' || g.id = json_extract_string(p.gateway_response, '$.productId')
  WHERE p.charge_status <> 'FAILED' AND k.type = 'star' AND k.status = 'COMPLETED' AND k.is_test_purchase IS DISTINCT FROM true
)
"""

PAYERS = """, money AS (
  SELECT CAST(t.first_purchase_at AS DATE) AS date_key, t.user_id, 'topup' AS type, t.star_package AS subtype,
    CAST(l.id AS VARCHAR) AS transaction_id, CAST(t.amount AS DECIMAL(28,4)) AS amount, 100 AS unit
  FROM user_topup_transaction AS t
  JOIN billing_ledger AS l ON CAST(l.paymee_order_id AS VARCHAR) = t.id AND NOT starts_with(l.user_id, 'internal')
  UNION ALL
  SELECT p.purchase_at, p.buyer_id, p.type, p.type, CAST(p.billing_transaction_id AS VARCHAR), p.amount, 100
  FROM star_purchase AS p
  WHERE p.type = 'transfer_inbound' AND p.buyer_id IS NOT NULL AND p.purchase_at >= coalesce(
    (SELECT min(q.purchase_at) FROM star_purchase AS q WHERE q.type = 'transfer_inbound' AND q.seller_id = p.buyer_id), p.purchase_at)
  UNION ALL
  SELECT transaction_date, user_id, replace(product_type, 'stripe', 'membership_direct'), product_type, consum_transaction_id,
    CAST(usd_amount AS DECIMAL(28,4)), 1
  FROM direct_event WHERE product_type IN ('stripe', 'donation_direct')
), monthly_pay_user AS (
  SELECT date_key, user_id, type, subtype, transaction_id, CAST(sum(amount) AS DOUBLE) / any_value(unit) AS usd_amount
  FROM money GROUP BY ALL
)
"""

SEGMENTATION = """, ranked AS (
  SELECT *, CASE WHEN usd IS NULL THEN 0 WHEN n = 1 AND usd <= 15000 THEN 1
      ELSE 2 + (usd > 30000)::INT + (usd > 60000)::INT + (usd > 150000)::INT + (usd > 300000)::INT END AS money,
    CASE WHEN n = 1 AND usd <= 15000 THEN 1 WHEN n = 1 THEN 2 ELSE 3 + (n > 3)::INT + (n > 7)::INT + (n > 10)::INT END AS often
  FROM (SELECT user_id, CAST(date_trunc('month', date_key) AS DATE) AS date_key, count(DISTINCT transaction_id) AS n,
      CAST(sum(CAST(usd_amount AS DECIMAL(28,6))) AS DOUBLE) AS usd FROM monthly_pay_user GROUP BY 1, 2)
), monthly_segmentation AS (
  SELECT u.date_key, u.user_id, k.usd AS monthly_usd_amount, k.n AS monthly_transaction_count,
    k.money AS monthly_monetary_rank, k.often AS monthly_frequency_rank,
    if(k.money = 0, 'others', ['N01. one_timer', 'N02. micro_user', 'N03. light_user', 'N04. casual_user', 'N05. power_user',
      'N06. whale_user'][k.money]) AS monthly_monetary_type,
    ['N01. tester', 'N02. one_timer', 'N03. occational_user', 'N04. engaged_user', 'N05. regular_user',
      'N06. enthusiastic_user'][k.often] AS monthly_frequency_type
  FROM (SELECT DISTINCT user_id, CAST(date_trunc('month', date_key) AS DATE) AS date_key FROM monthly_pay_user) AS u
  LEFT JOIN ranked AS k ON k.user_id = u.user_id AND k.date_key = u.date_key
)
"""

FLAGGING = """, pay_user_flagging AS (
  SELECT user_id, last_month AS nearest_active_month, if(m_rank IS NULL, 'retired', 'active') AS pay_user_type,
    coalesce(m_type, gone) AS current_monetary_type, coalesce(f_type, gone) AS current_frequency_type,
    coalesce(m_rank, 0) AS current_monetary_rank, coalesce(f_rank, 0) AS current_frequency_rank,
    coalesce(m_type, m_last) AS latest_active_monetary_type, coalesce(f_type, f_last) AS latest_active_frequency_type
  FROM (SELECT user_id, max(date_key) AS last_month,
      if(max(date_key) >= DATE '2001-08-01', 'Z. retired_recently', 'Z. retired_long_ago') AS gone,
      max(monthly_monetary_rank) FILTER (date_key >= DATE '2001-09-01') AS m_rank,
      max(monthly_monetary_type) FILTER (date_key >= DATE '2001-09-01') AS m_type,
      max(monthly_frequency_rank) FILTER (date_key >= DATE '2001-09-01') AS f_rank,
      max(monthly_frequency_type) FILTER (date_key >= DATE '2001-09-01') AS f_type,
      arg_max(monthly_monetary_type, date_key) AS m_last, arg_max(monthly_frequency_type, date_key) AS f_last
    FROM monthly_segmentation GROUP BY user_id)
)
"""

MASTER = """
SELECT l.date_key, l.user_id, l.type, l.subtype, l.transaction_id, l.usd_amount,
  s.* EXCLUDE (user_id, date_key), p.* EXCLUDE (user_id), m.* EXCLUDE (user_id, country, is_sus_social, is_suspicious_x_social),
  m.country AS user_country_code, m.is_sus_social OR m.is_suspicious_x_social AS is_suspicious_social,
  if(l.usd_amount IS NULL, 'others', ['N01. 0.00 - 0.50 usd', 'N02. 0.51 - 1.00 usd', 'N03. 1.01 - 3.00 usd', 'N04. 3.01 - 5.00 usd',
    'N05. 5.01 - 10.00 usd', 'N06. > 10.00 usd'][1 + (l.usd_amount > 15000)::INT + (l.usd_amount > 30000)::INT
    + (l.usd_amount > 90000)::INT + (l.usd_amount > 150000)::INT + (l.usd_amount > 300000)::INT]) AS transaction_amount_group
FROM monthly_pay_user AS l
LEFT JOIN monthly_segmentation AS s ON s.user_id = l.user_id AND s.date_key = date_trunc('month', l.date_key)
LEFT JOIN pay_user_flagging AS p ON p.user_id = l.user_id
LEFT JOIN user_master AS m ON m.user_id = l.user_id
"""


def payers(spark: SparkSession, sf_dir: str) -> Context:
    return context(spark, sf_dir, PAYERS_AS_OF)


def purchases_kept(spark: SparkSession, sf_dir: str) -> Context:
    """The payer ledger reads the purchases twice, so the transfers, in the few columns it needs, are stored first."""
    columns = ("type", "seller_id", "buyer_id", "purchase_at", "billing_transaction_id", "amount")
    return payers(spark, sf_dir).keep("star_purchase", *columns, where="type = 'transfer_inbound'")


@query("m01_star_purchase", ROLES + STAR_PURCHASE + "SELECT * FROM star_purchase")
def star_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payers(spark, sf_dir).ref("star_purchase")


@query("m02_user_topup_transaction", ROLES + TOPUP + "SELECT * FROM user_topup_transaction")
def user_topup_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payers(spark, sf_dir).ref("user_topup_transaction")


@query("m03_monthly_pay_user", ROLES + STAR_PURCHASE + TOPUP + PAYERS + "SELECT * FROM monthly_pay_user")
def monthly_pay_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchases_kept(spark, sf_dir).ref("monthly_pay_user")


@query(
    "m04_monthly_segmentation",
    ROLES + STAR_PURCHASE + TOPUP + PAYERS + SEGMENTATION + "SELECT * FROM monthly_segmentation",
)
def monthly_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchases_kept(spark, sf_dir).ref("monthly_segmentation")


@query(
    "m05_pay_user_flagging",
    ROLES + STAR_PURCHASE + TOPUP + PAYERS + SEGMENTATION + FLAGGING + "SELECT * FROM pay_user_flagging",
)
def pay_user_flagging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchases_kept(spark, sf_dir).ref("pay_user_flagging")


@query("m06_pay_user_master_data", ROLES + STAR_PURCHASE + TOPUP + PAYERS + SEGMENTATION + FLAGGING + MASTER)
def pay_user_master_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain: models that several others read are stored once."""
    ctx = purchases_kept(spark, sf_dir).keep("monthly_pay_user").keep("monthly_segmentation")
    return ctx.ref("pay_user_master_data")


DAILY = """
SELECT strftime(created_at, '%Y-%m-%d')::DATE AS transaction_date, created_at AS transaction_datetime, order_id, user_id,
  id::VARCHAR AS consum_transaction_id, -(sum(amount)::BIGINT / 100) AS usd_amount
FROM billing_ledger WHERE {where} GROUP BY ALL
"""


@query("m07_daily_transaction", ROLES + DAILY.format(where="true"))
def daily_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context(spark, sf_dir, ORDERS_AS_OF).ref("daily_transaction")


@query(
    "m08_ledger_transaction",
    ROLES + DAILY.format(where="year(created_at) = 1999"),
)
def ledger_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over overlapping windows merge to the rows of both."""
    ctx = context(spark, sf_dir, ORDERS_AS_OF, scratch_database(spark), ledger_version="created_at")
    run_slice(ctx, "ledger_transaction", dt.date(1999, 1, 1), dt.date(1999, 8, 1))
    run_slice(ctx, "ledger_transaction", dt.date(1999, 6, 1), dt.date(2000, 1, 1))
    return ctx.target("ledger_transaction").drop("part_transaction_datetime")


FOLLOW = """
  SELECT DISTINCT ON (c.owner_id, f.follower_id) CAST(f.created_at AS DATE) AS date_key, c.owner_id, f.follower_id,
    f.created_at AS followed_at, make_timestamp(0) AS unfollowed_at, true AS following_status,
    f.follower_id IN (SELECT id FROM user_account WHERE auto_follow = 1) AS is_auto_follow, 'follow' AS note
  FROM channel_follow AS f LEFT JOIN channel AS c ON c.id = f.channel_id
  WHERE f.created_at BETWEEN TIMESTAMP '{since}' AND TIMESTAMP '{until}'
  ORDER BY c.owner_id, f.follower_id, f.created_at DESC, f.channel_id
"""


@query("m09_latest_follow", ROLES + FOLLOW.format(since="2024-01-10", until="2024-12-31"))
def latest_follow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context(spark, sf_dir, dt.date(2024, 2, 10)).ref("latest_follow")


@query(
    "m10_daily_follower_following",
    ROLES
    + ", first_run AS ("
    + FOLLOW.format(since="2023-12-21", until="2024-01-20 23:59:59.999999")
    + "), second_run AS ("
    + FOLLOW.format(since="2024-01-20", until="2024-12-31")
    + """), changes AS (
  SELECT s.* REPLACE (if(owner_id IS NULL, TIMESTAMP '2024-02-20', unfollowed_at) AS unfollowed_at,
    owner_id IS NOT NULL AS following_status, if(owner_id IS NULL, 'unfollow', note) AS note)
  FROM second_run AS s ANTI JOIN first_run USING (owner_id, follower_id, date_key)
  WHERE owner_id IS NULL OR date_key >= DATE '2024-02-17'
  UNION ALL
  SELECT f.* REPLACE (TIMESTAMP '2024-02-20' AS unfollowed_at, false AS following_status, 'unfollow' AS note)
  FROM first_run AS f ANTI JOIN second_run USING (owner_id, follower_id, date_key)
), emitted AS (
  SELECT DISTINCT ON (owner_id, follower_id) * FROM changes ORDER BY owner_id, follower_id, date_key DESC
)
FROM emitted UNION ALL FROM first_run ANTI JOIN emitted USING (owner_id, follower_id, date_key)
""",
)
def daily_follower_following(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run on the follows known at a day, then a second run a month later."""
    name, database = "daily_follower_following", scratch_database(spark)
    first = context(spark, sf_dir, dt.date(2024, 1, 21), database)
    early = first.sources["channel_follow"].where(F.col("created_at") < F.lit("2024-01-21").cast("date"))
    first.sources = ChainMap({"channel_follow": early}, first.sources)
    run(first, name)
    run(context(spark, sf_dir, dt.date(2024, 2, 20), database), name)
    return spark.table(f"{database}.{name}").drop("part_date_key")


PERMISSION = """
  SELECT u.id AS user_id, a.alias, true AS is_allowed, DATE '{as_of}' AS created_at, DATE '{as_of}' AS last_updated_at
  FROM {listed} AS a JOIN user_account AS u ON coalesce(u.alias::VARCHAR, u.prev_alias) = a.alias::VARCHAR
"""


@query("m11_latest_transfer_permission", ROLES + PERMISSION.format(as_of="2024-03-01", listed="allow_list"))
def latest_transfer_permission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context(spark, sf_dir, dt.date(2024, 3, 1)).ref("latest_transfer_permission")


@query(
    "m12_transfer_permission_history",
    ROLES
    + ", early_list AS (SELECT s_suppkey AS alias FROM supplier WHERE s_acctbal < 6000), before AS ("
    + PERMISSION.format(as_of="2024-03-01", listed="early_list")
    + "), now AS ("
    + PERMISSION.format(as_of="2024-03-03", listed="allow_list")
    + """)
SELECT * REPLACE (user_id IN (SELECT user_id FROM now) AS is_allowed) FROM before
UNION ALL FROM now WHERE user_id NOT IN (SELECT user_id FROM before)
""",
)
def transfer_permission_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run on an earlier allow list, then a second run two days later on the present one."""
    name, database = "transfer_permission_history", scratch_database(spark)
    first = context(spark, sf_dir, dt.date(2024, 3, 1), database)
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    early = supplier.where("s_acctbal < 6000").select(F.col("s_suppkey").alias("alias"))
    first.sources = ChainMap({"allow_list": early}, first.sources)
    run(first, name)
    run(context(spark, sf_dir, dt.date(2024, 3, 3), database), name)
    return spark.table(f"{database}.{name}").drop("part_created_at")


@query(
    "m13_content_access",
    ROLES
    + """, sales AS (
  SELECT e.id AS order_id, e.product_id, p.type, p.subtype, r.id AS revenue_transaction_id,
    ifnull(e.event_code, r.event_code) AS event_code
  FROM ecom_product AS p JOIN ecom_order AS e ON e.product_id = p.id
  LEFT JOIN revenue_transaction AS r ON r.id = e.billing_transaction_id
  WHERE p.type = 'promo'
)
SELECT l.created_at::DATE AS transaction_date, l.created_at AS transaction_datetime, l.id::VARCHAR AS consum_transaction_id,
  sales.*, (SELECT id FROM user_account WHERE username = l.user_id) AS user_id, -(sum(l.amount)::BIGINT / 100) AS usd_amount
FROM sales JOIN billing_ledger AS l USING (order_id)
WHERE l.type = 'consumption' AND l.created_at >= DATE '2001-07-30' - 2000
GROUP BY ALL
""",
)
def content_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context(spark, sf_dir, ORDERS_AS_OF, access_days=2000).ref("content_access")


# The pairs are written out here again, so that a fault in the model's list shows.
PUSHED = (
    ("os", "$os"), ("utm_campaign", "utm_campaign"), ("browser", "$browser"), ("country_name", "$geoip_country_name"),
    ("ip", "$ip"), ("distinct_id_properties", "distinct_id"), ("browser_version", "$browser_version"), ("device", "$device"),
    ("os_version", "$os_version"), ("raw_user_agent", "$raw_user_agent"), ("session_id", "$session_id"),
    ("browser_language", "$browser_language"),
)


def _push_sql() -> str:
    picked = ", ".join(
        f"CASE WHEN json_type(properties, '$.\"{key}\"') = 'VARCHAR' "
        f"THEN json_extract_string(properties, '$.\"{key}\"') ELSE '' END AS {name}"
        for name, key in PUSHED
    )
    return f"""
SELECT distinct_id, created_at, event, uuid, {picked}, "$session_id", "$window_id", "$session_id_uuid", person_mode
FROM analytics_event
WHERE created_at >= DATE '2024-01-06' AND properties LIKE '%push_spring%'
"""


@query("m14_campaign_push", ROLES + _push_sql())
def campaign_push(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context(spark, sf_dir, EVENTS_AS_OF).ref("campaign_push")


@query(
    "m15_slice_copy",
    ROLES + "SELECT * FROM sliced_table WHERE created_at >= DATE '2024-01-05' AND created_at < DATE '2024-01-20'",
)
def slice_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context(
        spark, sf_dir, EVENTS_AS_OF, start_date=dt.date(2024, 1, 5), end_date=dt.date(2024, 1, 20)
    ).ref("slice_copy")


@query(
    "m16_copied_table_merge",
    ROLES
    + """
SELECT * FROM copied_table
QUALIFY row_number() OVER (PARTITION BY creator_id, ingest_cycle ORDER BY ingest_at DESC, payout_id) = 1
""",
)
def copied_table_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored in two runs: the later rows first, so that most rows of the second run lose by their version."""
    ctx = context(spark, sf_dir, ORDERS_AS_OF, scratch_database(spark))
    rows, sources = ctx.source("copied_table"), ctx.sources
    later = F.col("ingest_at") >= F.lit("1998-06-01").cast("date")
    for part in (rows.where(later), rows.where(~later)):
        ctx.sources = ChainMap({"copied_table": part}, sources)
        run(ctx, "copied_table")
    return ctx.target("copied_table").drop("part_ingest_at")
