"""Incremental maintenance on frames (I rows of the inventory)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog import query, table
from ledgerloom.catalog.roles import cents
from ledgerloom.catalog.scans import VERSIONED, versioned
from ledgerloom.operators import incremental as inc
from ledgerloom.operators.numbering import number_rows
from ledgerloom.session import scratch_database
from ledgerloom.sources import tables


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Altered orders as a stored target (versions 1 and 2) and new rows (versions 2 and 3)."""
    rows = versioned(spark, sf_dir)
    return rows.where("version < 2"), rows.where("version >= 2")


@query(
    "i02_versioned_upsert",
    VERSIONED + "SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) = 1",
)
def versioned_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows merged twice: the second merge changes nothing."""
    target, new = _split(spark, sf_dir)
    once = inc.upsert(target, new, "o_orderkey", "version")
    return inc.upsert(once, new, "o_orderkey", "version")


@query(
    "i03_newest_insert",
    VERSIONED
    + """
SELECT * FROM v WHERE version = 2
UNION ALL SELECT * FROM v AS old WHERE version = 1 AND NOT EXISTS (SELECT 1 FROM v WHERE v.version = 2 AND v.o_orderkey = old.o_orderkey)
""",
)
def newest_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, new = _split(spark, sf_dir)
    return inc.upsert(target, new.where("version = 2"), "o_orderkey")


@query(
    "i05_compact",
    VERSIONED + "SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) = 1",
)
def compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = inc.compact(versioned(spark, sf_dir), "o_orderkey", "version")
    return inc.compact(once, "o_orderkey", "version")


EDGES = """
WITH edges AS (SELECT CAST(ts AS DATE) AS date_key, user_id AS owner_id, event_type AS follower_id, ts AS followed_at,
  true AS following_status, user_id < 75 AS is_auto_follow FROM events),
stored AS (SELECT DISTINCT ON (owner_id, follower_id) * FROM edges WHERE followed_at < DATE '2024-01-27'
  ORDER BY owner_id, follower_id, followed_at DESC),
snapshot AS (SELECT DISTINCT ON (owner_id, follower_id) * FROM edges WHERE followed_at >= DATE '2024-01-26'
  ORDER BY owner_id, follower_id, followed_at DESC)
"""


def _edges(spark: SparkSession, sf_dir: str, kept) -> DataFrame:
    from ledgerloom.operators.windows import latest_per_key

    rows = table(spark, sf_dir, "events").where(kept)
    rows = rows.select(F.col("user_id").alias("owner_id"), F.col("event_type").alias("follower_id"), "ts")
    newest = latest_per_key(rows, ["owner_id", "follower_id"], "ts")
    return newest.select(
        F.to_date("ts").alias("date_key"),
        "owner_id",
        "follower_id",
        F.col("ts").alias("followed_at"),
        F.lit(True).alias("following_status"),
        (F.col("owner_id") < 75).alias("is_auto_follow"),
    )


@query(
    "i08_edge_diff",
    EDGES
    + """
SELECT DISTINCT ON (owner_id, follower_id) * FROM (
  SELECT *, make_timestamp(0) AS unfollowed_at, 'follow' AS note
  FROM snapshot ANTI JOIN stored USING (owner_id, follower_id, date_key) WHERE date_key >= DATE '2024-01-28'
  UNION ALL
  SELECT * REPLACE (false AS following_status), TIMESTAMP '2024-01-31 06:00:00', 'unfollow'
  FROM stored ANTI JOIN snapshot USING (owner_id, follower_id, date_key))
ORDER BY owner_id, follower_id, date_key DESC
""",
)
def edge_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _edges(spark, sf_dir, F.col("ts") < F.lit(dt.date(2024, 1, 27)))
    latest = _edges(spark, sf_dir, F.col("ts") >= F.lit(dt.date(2024, 1, 26)))
    return inc.edge_diff(target, latest, dt.datetime(2024, 1, 31, 6))


@query(
    "i08_stored_edges",
    EDGES
    + """
SELECT *, make_timestamp(0) AS unfollowed_at, 'follow' AS note FROM stored
UNION ALL FROM (SELECT DISTINCT ON (owner_id, follower_id) * FROM (
  SELECT *, make_timestamp(0) AS unfollowed_at, 'follow' AS note
  FROM snapshot ANTI JOIN stored USING (owner_id, follower_id, date_key) WHERE date_key >= DATE '2024-01-28'
  UNION ALL
  SELECT * REPLACE (false AS following_status), TIMESTAMP '2024-01-31 06:00:00', 'unfollow'
  FROM stored ANTI JOIN snapshot USING (owner_id, follower_id, date_key))
ORDER BY owner_id, follower_id, date_key DESC)
""",
)
def stored_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history of edges in a stored table, from two snapshots."""
    name = f"{scratch_database(spark)}.edges"
    never = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    first, second = (
        _edges(spark, sf_dir, kept).withColumns({"unfollowed_at": never, "note": F.lit("follow")})
        for kept in (F.col("ts") < F.lit(dt.date(2024, 1, 27)), F.col("ts") >= F.lit(dt.date(2024, 1, 26)))
    )
    for snapshot, day in ((first, dt.datetime(2024, 1, 27, 6)), (second, dt.datetime(2024, 1, 31, 6))):
        tables.record_edges(snapshot, name, day)
    return spark.table(name).drop(tables.RUN)


DIMS = """
WITH stored AS (SELECT c_custkey AS user_id, c_name AS alias, c_acctbal > 2000 AS is_allowed,
    DATE '2024-03-01' - c_nationkey::INT AS created_at, DATE '2024-03-01' - c_nationkey::INT AS last_updated_at
  FROM customer WHERE c_mktsegment <> 'BUILDING'),
snapshot AS (SELECT c_custkey AS user_id, c_name AS alias, true AS is_allowed, DATE '2024-03-05' AS created_at,
    DATE '2024-03-05' AS last_updated_at
  FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE'))
"""


def _dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customers = table(spark, sf_dir, "customer")
    day = F.date_sub(F.lit(dt.date(2024, 3, 1)), F.col("c_nationkey").cast("int"))
    names = [F.col("c_custkey").alias("user_id"), F.col("c_name").alias("alias")]
    target = customers.where("c_mktsegment != 'BUILDING'").select(
        *names, (F.col("c_acctbal") > 2000).alias("is_allowed"), day.alias("created_at"), day.alias("last_updated_at")
    )
    today = F.lit(dt.date(2024, 3, 5))
    latest = customers.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "FURNITURE")).select(
        *names, F.lit(True).alias("is_allowed"), today.alias("created_at"), today.alias("last_updated_at")
    )
    return target, latest


@query(
    "i09_dim_diff",
    DIMS
    + """
FROM snapshot ANTI JOIN stored USING (user_id)
UNION ALL
SELECT * REPLACE (false AS is_allowed) FROM stored ANTI JOIN snapshot USING (user_id) WHERE created_at >= DATE '2024-02-25'
""",
)
def dim_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.dim_diff(*_dims(spark, sf_dir), dt.date(2024, 3, 5), window_days=9)


@query(
    "i09_dim_diff_strict",
    DIMS
    + """
FROM snapshot ANTI JOIN stored USING (user_id)
UNION ALL
SELECT * REPLACE (NOT is_allowed AS is_allowed, DATE '2024-03-05' AS last_updated_at) FROM stored
WHERE is_allowed <> (user_id IN (SELECT user_id FROM snapshot))
""",
)
def dim_diff_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.dim_diff(*_dims(spark, sf_dir), dt.date(2024, 3, 5), strict=True)


@query(
    "i13_process_remaining",
    """
WITH done AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS row_number FROM events WHERE event_type = 'view'),
fresh AS (SELECT event_id, value, row_number() OVER (ORDER BY event_id) AS rn FROM events
  WHERE event_type <> 'view' AND value >= 1)
SELECT CAST((SELECT max(row_number) FROM done) + rn AS BIGINT) AS row_number, event_id AS key_column, TIMESTAMP '2024-02-01 07:30:00' AS write_time, value
FROM fresh
""",
)
def process_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views are in the log already; the work gives no result for tiny values, which stay out of the log."""
    events = table(spark, sf_dir, "events").select("event_id", "value", "event_type")
    viewed = number_rows(events.where("event_type = 'view'").select(F.col("event_id").alias("key_column")), ["key_column"])
    now = dt.datetime(2024, 2, 1, 7, 30)
    return inc.process_remaining(
        events, viewed, lambda df: df.where("value >= 1").select("event_id", "value"), "event_id", now, ["event_id"]
    )


@query(
    "i18_scd2",
    """
WITH old AS (SELECT c_custkey, c_mktsegment, c_nationkey FROM customer WHERE c_acctbal < 8000),
new AS (SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN 'GARDEN' ELSE c_mktsegment END AS c_mktsegment, c_nationkey FROM customer WHERE c_acctbal > 0)
SELECT c_custkey, c_mktsegment, c_nationkey, DATE '2024-01-01' AS valid_from,
  CASE WHEN EXISTS (SELECT 1 FROM new WHERE new.c_custkey = old.c_custkey AND new.c_mktsegment <> old.c_mktsegment)
    OR NOT EXISTS (SELECT 1 FROM new WHERE new.c_custkey = old.c_custkey) THEN DATE '2024-02-01' END AS valid_to FROM old
UNION ALL
SELECT c_custkey, c_mktsegment, c_nationkey, DATE '2024-02-01', NULL FROM new
WHERE NOT EXISTS (SELECT 1 FROM old WHERE new.c_custkey = old.c_custkey AND new.c_mktsegment = old.c_mktsegment)
""",
)
def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    segment = F.when(F.col("c_nationkey") < 5, "GARDEN").otherwise(F.col("c_mktsegment")).alias("c_mktsegment")
    old = customers.where("c_acctbal < 8000").select(
        "c_custkey", "c_mktsegment", "c_nationkey", F.lit(dt.date(2024, 1, 1)).alias("valid_from")
    )
    new = customers.where("c_acctbal > 0").select("c_custkey", segment, "c_nationkey")
    stored = old.withColumn("valid_to", F.lit(None).cast("date"))
    once = inc.scd2(stored, new, "c_custkey", dt.date(2024, 2, 1), close_missing=True)
    return inc.scd2(once, new, "c_custkey", dt.date(2024, 3, 1), close_missing=True)


@query(
    "i18_stored_history",
    """
WITH days AS (SELECT * FROM (VALUES (1, DATE '2024-01-01'), (2, DATE '2024-02-01'), (3, DATE '2024-03-01')) d(n, day)),
seen AS (
  SELECT 1 AS n, c_custkey, c_mktsegment, c_nationkey FROM customer WHERE c_acctbal < 8000
  UNION ALL SELECT 2, c_custkey, CASE WHEN c_nationkey < 5 THEN 'GARDEN' ELSE c_mktsegment END, c_nationkey FROM customer WHERE c_acctbal > 0
  UNION ALL SELECT 3, c_custkey, c_mktsegment, c_nationkey FROM customer WHERE c_acctbal < 9000),
begun AS (SELECT *, CASE WHEN lag(n) OVER w = n - 1 AND lag(c_mktsegment) OVER w = c_mktsegment THEN 0 ELSE 1 END AS new
  FROM seen WINDOW w AS (PARTITION BY c_custkey ORDER BY n)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY c_custkey ORDER BY n) AS run FROM begun),
spans AS (SELECT c_custkey, c_mktsegment, c_nationkey, min(n) AS first, max(n) AS last FROM runs GROUP BY c_custkey, run, c_mktsegment, c_nationkey)
SELECT c_custkey, c_mktsegment, c_nationkey, a.day AS valid_from, b.day AS valid_to
FROM spans JOIN days a ON a.n = first LEFT JOIN days b ON b.n = last + 1
""",
)
def stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three snapshots recorded in a stored table, the second one twice."""
    customers, name = table(spark, sf_dir, "customer"), f"{scratch_database(spark)}.history"
    segment = F.when(F.col("c_nationkey") < 5, "GARDEN").otherwise(F.col("c_mktsegment")).alias("c_mktsegment")
    snapshots = [
        (1, customers.where("c_acctbal < 8000").select("c_custkey", "c_mktsegment", "c_nationkey")),
        (2, customers.where("c_acctbal > 0").select("c_custkey", segment, "c_nationkey")),
        (3, customers.where("c_acctbal < 9000").select("c_custkey", "c_mktsegment", "c_nationkey")),
    ]
    for month, rows in (*snapshots[:2], *snapshots[1:]):
        tables.record_history(rows, name, "c_custkey", dt.date(2024, month, 1), close_missing=True)
    return tables.read_history(spark, name)


@query(
    "i20_summing",
    "SELECT o_custkey, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total FROM orders GROUP BY ALL",
)
def summing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", F.lit(1).cast("bigint").alias("n"), cents("o_totalprice").alias("total")
    )
    stored = rows.where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    return inc.summing([stored, rows.where("o_orderstatus != 'F'").drop("o_orderstatus")], "o_custkey", ["n", "total"])


@query(
    "i21_aggregate_states",
    """
SELECT o_custkey, count(c) AS n, CAST(sum(c) AS BIGINT) AS total, min(c) AS low, max(c) AS high, CAST(sum(c) AS BIGINT) / count(c) AS mean
FROM (SELECT o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders) GROUP BY ALL
""",
)
def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily states merged to one state per buyer."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), cents("o_totalprice").alias("c"))
    daily = inc.agg_state(rows, ["o_custkey", "day"], "c")
    return inc.finish_states(inc.merge_states(daily, "o_custkey"))


@query(
    "i21_distinct_states",
    "SELECT year(o_orderdate) AS year, count(o_orderkey) AS n, count(DISTINCT o_custkey) AS buyers, true AS close FROM orders GROUP BY ALL",
)
def distinct_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sketches merged to years; the estimates lie within a tenth of the exact counts beside them."""
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    daily = orders.withColumn("day", F.to_date("o_orderdate"))
    yearly = inc.merge_states(inc.agg_state(daily, ["year", "day"], "o_orderkey", distinct="o_custkey"), "year")
    exact = orders.groupBy("year").agg(F.countDistinct("o_custkey").alias("buyers"))
    close = F.abs(F.col("distinct_estimate") - F.col("buyers")) <= F.col("buyers") * 0.1
    both = inc.finish_states(yearly).join(exact, "year")
    return both.select(F.col("year").cast("long").alias("year"), "n", "buyers", close.alias("close"))


SIGNED = """
WITH s AS (SELECT o_orderkey, version, o_totalprice, 1 AS sign FROM v
  UNION ALL SELECT o_orderkey, version, o_totalprice, -1 FROM v WHERE version < 3 AND o_totalprice < 600000)
"""


def _signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions written with +1, and most of the lower ones taken back with -1."""
    rows = versioned(spark, sf_dir)
    back = rows.where("version < 3 AND o_totalprice < 600000").withColumn("sign", F.lit(-1))
    return rows.withColumn("sign", F.lit(1)).unionByName(back)


@query(
    "i21_quantile_states",
    "SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n, true AS close FROM orders GROUP BY ALL",
)
def quantile_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily quantile sketches merged to months; the share of orders up to each estimate lies within 0.03 of its own.

    Where a value is that of many orders the shares on either side of it count.
    """
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("long").alias("year"), F.month("o_orderdate").cast("long").alias("month"), F.to_date("o_orderdate").alias("day"), cents("o_totalprice").alias("c"))
    daily = inc.agg_state(orders, ["year", "month", "day"], "c", quantiles=True)
    shares = (0.1, 0.5, 0.9)
    monthly = inc.finish_states(inc.merge_states(daily, ["year", "month"]), shares).drop("n")
    both = orders.join(monthly, ["year", "month"])
    slack = F.greatest(F.lit(0.03), 1 / F.count(F.lit(1)))
    inside = [(F.avg((F.col("c") <= F.col(f"q{s * 100:g}")).cast("int")) >= s - slack) & (F.avg((F.col("c") < F.col(f"q{s * 100:g}")).cast("int")) <= s + slack) for s in shares]
    return both.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"), (inside[0] & inside[1] & inside[2]).alias("close"))


@query(
    "i22_collapse",
    VERSIONED
    + ", "
    + SIGNED.strip().removeprefix("WITH ")
    + """
SELECT * FROM s WHERE sign = 1 AND o_orderkey IN (SELECT o_orderkey FROM s GROUP BY 1 HAVING sum(sign) > 0)
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) = 1
""",
)
def collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.collapse(_signed(spark, sf_dir), "o_orderkey", "sign", "version")


@query(
    "i23_collapse_versions",
    VERSIONED
    + ", "
    + SIGNED.strip().removeprefix("WITH ")
    + "SELECT o_orderkey, version, any_value(o_totalprice) AS o_totalprice, CAST(1 AS INTEGER) AS sign FROM s GROUP BY 1, 2 HAVING sum(sign) > 0",
)
def collapsed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.collapse_versions(_signed(spark, sf_dir), "o_orderkey", "sign", "version")


@query(
    "i24_rollup_by_age",
    """
SELECT event_type, grain, bucket_at, count(c) AS n, CAST(sum(c) AS BIGINT) AS total, min(c) AS low, max(c) AS high FROM (
  SELECT event_type, CAST(round(value * 100) AS BIGINT) AS c,
    CASE WHEN date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') >= 20 THEN 'day' WHEN date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') >= 7 THEN 'hour' ELSE 'minute' END AS grain,
    CAST(date_trunc(CASE WHEN date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') >= 20 THEN 'day' WHEN date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') >= 7 THEN 'hour' ELSE 'minute' END, ts) AS TIMESTAMP) AS bucket_at
  FROM events) GROUP BY ALL
""",
)
def aged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_type", "ts", cents("value").alias("c"))
    rules = [(0, "minute"), (7, "hour"), (20, "day")]
    return inc.rollup_by_age(rows, "event_type", "ts", "c", rules, dt.date(2024, 1, 31))
