"""Stored tables (K rows and the storing I rows of the inventory): each query stores a table and reads it back."""

from __future__ import annotations

import datetime as dt
from collections import ChainMap

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import ledgerloom.plans.marts  # noqa: F401  (registers the models)
from ledgerloom.catalog import query, table
from ledgerloom.catalog.roles import ROLES, context
from ledgerloom.functions.dates import refresh_windows
from ledgerloom.operators.sets import union_all
from ledgerloom.plans.registry import MODELS, Model, backfill, run, run_slice
from ledgerloom.session import scratch_database, scratch_path
from ledgerloom.sources import tables
from ledgerloom.sources.readers import load_csv
from ledgerloom.streaming.copy import continuous_copy, read_copy


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


ORDERS = "SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders "


@query("k01_replace_table", ORDERS + "WHERE o_totalprice > 250000")
def replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, orders = f"{scratch_database(spark)}.t", _orders(spark, sf_dir)
    tables.write(orders, name)
    tables.write(orders.where("o_totalprice > 250000"), name)
    return spark.table(name)


@query("k02_append", ORDERS + "UNION ALL " + ORDERS + "WHERE o_totalprice > 250000")
def append(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, orders = f"{scratch_database(spark)}.t", _orders(spark, sf_dir)
    tables.write(orders, name, "append")
    tables.write(orders.where("o_totalprice > 250000"), name, "append")
    return spark.table(name)


REPLACED = """
WITH fresh AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice * 2 AS o_totalprice FROM orders
  WHERE o_orderdate >= DATE '1998-03-10' AND o_orderdate < DATE '1998-05-02' AND dayofweek(o_orderdate) = 1)
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate NOT IN (SELECT o_orderdate FROM fresh)
UNION ALL SELECT * FROM fresh
"""


def _fresh(orders: DataFrame) -> DataFrame:
    """Doubled orders of the Mondays of some weeks."""
    day = F.col("o_orderdate")
    chosen = (day >= F.lit(dt.date(1998, 3, 10))) & (day < F.lit(dt.date(1998, 5, 2))) & (F.dayofweek(day) == 2)
    return orders.where(chosen).withColumn("o_totalprice", F.col("o_totalprice") * 2)


@query("k03_replace_by_values", REPLACED)
def replace_by_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days replaced in a table of months: only the listed days go. Done twice, with the same result."""
    name, orders = f"{scratch_database(spark)}.t", _orders(spark, sf_dir)
    tables.write_partitioned(orders, name, "o_orderdate", "MONTH")
    fresh = _fresh(orders).withColumn("part_o_orderdate", F.date_format("o_orderdate", "yyyy-MM"))
    for _ in range(2):
        tables.replace_by_values(fresh, name, "o_orderdate")
    return spark.table(name).drop("part_o_orderdate")


@query("k04_partitioned_write", "SELECT *, strftime(o_orderdate, '%Y-%m') AS part_o_orderdate FROM orders WHERE o_orderdate >= DATE '1999-01-15' AND o_orderdate < DATE '1999-03-15'")
def partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{scratch_database(spark)}.t"
    tables.write_partitioned(table(spark, sf_dir, "orders"), name, "o_orderdate", "MONTH", sort_by="o_orderkey")
    return tables.read_slice(spark, name, dt.date(1999, 1, 15), dt.date(1999, 3, 15))


@query("k05_update_table", REPLACED)
def update_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, orders = f"{scratch_database(spark)}.t", _orders(spark, sf_dir)
    tables.update_table(orders, name, "truncate", "o_orderdate", "MONTH")
    tables.update_table(_fresh(orders), name, "truncate_partition", "o_orderdate", "MONTH")
    return spark.table(name).drop("part_o_orderdate")


@query(
    "k06_clustered_join",
    "SELECT l_orderkey, l_linenumber, l_partkey, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides stored bucketed by the join key: the join needs no shuffle."""
    database = scratch_database(spark)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    tables.write_bucketed(lines, f"{database}.lines", "l_orderkey", 8)
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    tables.write_bucketed(orders, f"{database}.orders", "l_orderkey", 8)
    return spark.table(f"{database}.lines").join(spark.table(f"{database}.orders"), "l_orderkey")


@query(
    "k06_interleaved",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
WHERE l_suppkey <= (SELECT max(l_suppkey) / 10 FROM lineitem) OR l_shipdate >= DATE '1998-06-01'
""",
)
def clustered_on_several(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines stored by part, supplier and date at once, filtered by the second and the third of them."""
    name = f"{scratch_database(spark)}.lines"
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    tables.write_interleaved(lines, name, ["l_partkey", "l_suppkey", "l_shipdate"])
    most = lines.agg(F.max("l_suppkey")).first()[0]
    return spark.table(name).where((F.col("l_suppkey") <= most / 10) | (F.col("l_shipdate") >= F.lit(dt.date(1998, 6, 1))))


@query(
    "k07_conform",
    """
SELECT CAST(c_custkey AS BIGINT) AS id, CAST(c_nationkey AS BIGINT) AS nation, c_acctbal > 0 AS ok, c_name AS name,
  CAST(c_acctbal AS DOUBLE) AS balance, CAST(CASE WHEN c_acctbal > 0 THEN DATE '2024-01-01' + CAST(c_nationkey AS INTEGER) ELSE DATE '1970-01-01' END AS TIMESTAMP) AS since,
  CAST(CAST(c_nationkey AS SMALLINT) AS BIGINT) AS small FROM customer
""",
)
def conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    since = F.when(F.col("c_acctbal") > 0, F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("c_nationkey").cast("int")))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").alias("nation"),
        (F.col("c_acctbal") > 0).alias("ok"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("balance"),
        since.alias("since"),
        F.col("c_nationkey").cast("smallint").alias("small"),
    )
    return tables.conform_for_ingest(customers)


@query(
    "k08_ingest",
    "SELECT event_id, ts, user_id, event_type, value, strftime(ts, '%Y-%m') AS part_ts FROM events WHERE user_id >= 50 "
    "UNION ALL SELECT event_id, ts, user_id, event_type, value, strftime(ts, '%Y-%m') FROM events WHERE user_id < 50",
)
def ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, events = f"{scratch_database(spark)}.t", table(spark, sf_dir, "events").drop("props")
    tables.ingest(events, name, "append", "ts")
    tables.ingest(events.where("user_id >= 50"), name, "truncate", "ts")
    tables.ingest(events.where("user_id < 50"), name, "append", "ts")
    return spark.table(name)


@query("k09_export", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as csv, json and parquet; read back from all three, each giving the same rows."""
    folder = scratch_path(spark, "export")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    paths = {kind: tables.export(orders, folder, "orders", kind) for kind in ("csv", "json", "parquet")}
    back = [
        load_csv(spark, paths["csv"], orders.schema),
        spark.read.schema(orders.schema).json(paths["json"]),
        spark.read.parquet(paths["parquet"]),
    ]
    return back[0].intersect(back[1]).intersect(back[2])


@query(
    "k10_add_columns",
    "SELECT r_regionkey, c_custkey, CASE WHEN c_custkey >= 100 THEN 'late' END AS note FROM customer "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
def add_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{scratch_database(spark)}.t"
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("r_regionkey"))
    rows = table(spark, sf_dir, "customer").join(nation, "c_nationkey").select("r_regionkey", "c_custkey")
    tables.write(rows.where("c_custkey < 100"), name)
    tables.add_columns(spark, name, note="string")
    tables.write(rows.where("c_custkey >= 100").withColumn("note", F.lit("late")), name, "append")
    return spark.table(name)


@query(
    "k11_table_schema",
    """
SELECT column_name AS "column", CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
  ELSE lower(data_type) END AS type
FROM information_schema.columns WHERE table_name = 'orders'
""",
)
def table_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{scratch_database(spark)}.t"
    tables.write(table(spark, sf_dir, "orders"), name)
    return spark.createDataFrame(tables.table_schema(spark, name), "column string, type string")


@query("k12_expire_table", "SELECT * FROM orders WHERE o_orderkey % 2 = 0")
def expired_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders in two tables, of which one has expired by the day of the clean-up and the other has not."""
    database, orders = scratch_database(spark), table(spark, sf_dir, "orders")
    names = [f"{database}.even", f"{database}.odd"]
    for name, rest, days in zip(names, (0, 1), (60, 10)):
        tables.write(orders.where(F.col("o_orderkey") % 2 == rest), name)
        tables.set_table_expiry(spark, name, days, dt.date(2001, 1, 1))
    for name in names:
        tables.expire_table(spark, name, dt.date(2001, 2, 1))
    return union_all(*[spark.table(n) for n in names if tables.exists(spark, n)])


@query("k13_expire_partitions", ORDERS + "WHERE date_trunc('month', o_orderdate) >= DATE '2001-08-01' - 365")
def expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also sets and checks an expiry for the whole table, which has not come yet."""
    name, as_of = f"{scratch_database(spark)}.t", dt.date(2001, 8, 1)
    tables.write_partitioned(_orders(spark, sf_dir), name, "o_orderdate", "MONTH")
    tables.expire_partitions(spark, name, 365, as_of)
    tables.set_table_expiry(spark, name, 30, as_of)
    tables.expire_table(spark, name, as_of)
    return spark.table(name).drop("part_o_orderdate")


@query("k14_required_slice", ORDERS + "WHERE o_orderdate >= DATE '2000-01-01' AND o_orderdate < DATE '2000-04-01'")
def required_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{scratch_database(spark)}.t"
    orders = _orders(spark, sf_dir)
    tables.update_table(orders, name, "truncate", "o_orderdate", "MONTH", partition_expiry_days=9999, partition_filter=True)
    return tables.read_slice(spark, name, dt.date(2000, 1, 1), dt.date(2000, 4, 1)).drop("part_o_orderdate")


@query(
    "k15_ingest_date",
    "SELECT c_custkey, DATE '2024-01-01' AS _ingest_date FROM customer WHERE c_acctbal < 0 UNION ALL SELECT c_custkey, DATE '2024-01-02' FROM customer WHERE c_acctbal >= 0",
)
def ingest_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, customers = f"{scratch_database(spark)}.t", table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    tables.append_with_ingest_date(customers.where("c_acctbal < 0").drop("c_acctbal"), name, dt.date(2024, 1, 1))
    tables.append_with_ingest_date(customers.where("c_acctbal >= 0").drop("c_acctbal"), name, dt.date(2024, 1, 2))
    return spark.table(name)


@query("k16_k17_truncate_and_ctas", "SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def truncate_and_ctas(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = scratch_database(spark)
    tables.write(table(spark, sf_dir, "customer"), f"{database}.customer")
    tables.truncate(spark, f"{database}.customer")
    tables.write(table(spark, sf_dir, "customer"), f"{database}.customer", "append")
    tables.write(table(spark, sf_dir, "nation"), f"{database}.nation")
    text = f"SELECT n_name, count(*) AS n FROM {database}.customer JOIN {database}.nation ON c_nationkey = n_nationkey GROUP BY ALL"
    tables.ctas(spark, f"{database}.report", text)
    tables.drop(spark, f"{database}.customer")
    return spark.table(f"{database}.report")


@query("k18_continuous_copy", "SELECT * FROM events")
def streamed_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten deliveries, later ones of older rows and with a part of those before again, in a micro-batch each.

    The stream is stopped and started again after the fourth and the seventh, and at last finds nothing new.
    """
    source, target, checkpoint = (scratch_path(spark, x) for x in ("delivery", "copy", "copy-state"))
    events = table(spark, sf_dir, "events")
    turn = F.pmod(F.lit(10) - F.dayofyear("ts"), F.lit(10))
    for number in range(10):
        again = (turn < number) & (F.pmod(F.col("event_id") + number, F.lit(7)) == 0)
        events.where((turn == number) | again).write.mode("append").parquet(source)
        if number in (3, 6, 9):
            copy = continuous_copy(spark, source, events.schema, target, checkpoint, ["event_id"], files_per_batch=1)
            copy.awaitTermination()
    continuous_copy(spark, source, events.schema, target, checkpoint, ["event_id"]).awaitTermination()
    return read_copy(spark, events.schema, target)


@query("i01_i16_stored_models", ROLES + "SELECT CAST(id AS VARCHAR) AS consum_transaction_id, user_id FROM billing_ledger")
def stored_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An incremental model run twice by path: the second run merges the same rows again."""
    database = scratch_database(spark)
    for _ in range(2):
        run(context(spark, sf_dir, dt.date(2001, 8, 5), database), "path:merged/ledger_transaction")
    return spark.table(f"{database}.ledger_transaction").select("consum_transaction_id", "user_id")


@query("i14_i16_tagged_run", "SELECT o_orderkey, o_custkey FROM orders")
def tagged_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tag runs a table, which a hook before it has emptied of older rows and a hook after it compacts, and a view of it."""
    ctx = context(spark, sf_dir, dt.date(2001, 8, 5), scratch_database(spark))
    orders = _orders(spark, sf_dir)
    copies, name = ctx.table("order_copies"), f"orders_of_{ctx.database}"
    tables.write_partitioned(orders.withColumn("o_custkey", F.lit(-1).cast("long")), copies, "o_orderdate", "YEAR", "overwrite")
    models = (
        Model(
            "order_copies", lambda c: orders.union(orders), tags=("hooked",), path="sliced/order_copies",
            materialized="incremental", partition_by=("o_orderdate", "YEAR"),
            pre=lambda c: tables.truncate(c.spark, copies),
            post=lambda c: tables.compact_table(c.spark, copies, "o_orderkey", "o_orderdate", "o_custkey"),
        ),
        Model(
            name, lambda c: c.target("order_copies").select("o_orderkey", "o_custkey"), after=("order_copies",),
            tags=("hooked",), path=f"view/{name}", materialized="view",
        ),
    )
    MODELS.update({m.name: m for m in models})
    try:
        run(ctx, "tag:hooked")
    finally:
        for m in models:
            del MODELS[m.name]
    return spark.table(name)


@query("i04_i06_lazy_duplicates", "SELECT * FROM orders")
def lazy_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows appended twice, read as if merged, then compacted in place."""
    name = f"{scratch_database(spark)}.t"
    orders = table(spark, sf_dir, "orders")
    for _ in range(2):
        tables.write_partitioned(orders, name, "o_orderdate", "YEAR", "append")
    tables.compact_table(spark, name, "o_orderkey", "o_orderdate", "o_custkey")
    return spark.table(name).drop("part_o_orderdate")


@query(
    "i10_i12_backfill",
    ROLES + "SELECT * FROM sliced_table WHERE created_at >= DATE '2024-01-01' AND created_at < DATE '2024-02-01'",
)
def backfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job for the whole range, then the same range again slice by slice."""
    ctx = context(spark, sf_dir, dt.date(2024, 2, 1), scratch_database(spark))
    backfill(ctx, "slice_copy", dt.date(2024, 1, 1), dt.date(2024, 2, 1))
    backfill(ctx, "slice_copy", dt.date(2023, 12, 1), dt.date(2024, 2, 1), one_by_one=True)
    return ctx.target("slice_copy").drop("part_created_at")


@query(
    "i11_rolling_refresh",
    ROLES + "SELECT * FROM sliced_table WHERE created_at >= DATE '2023-10-01' AND created_at < DATE '2024-03-01'",
)
def rolling_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows of the last four months and this one, each built as a slice of its own, twice."""
    ctx = context(spark, sf_dir, dt.date(2024, 2, 10), scratch_database(spark))
    for first, last in 2 * refresh_windows(ctx.as_of):
        run_slice(ctx, "slice_copy", first, last)
    return ctx.target("slice_copy").drop("part_created_at")


@query(
    "i17_copy_and_build",
    ROLES
    + "SELECT * FROM copied_table QUALIFY row_number() OVER (PARTITION BY creator_id, ingest_cycle ORDER BY ingest_at DESC, payout_id) = 1",
)
def copy_and_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query result to typed ingest to merged model, without passing the driver."""
    database = scratch_database(spark)
    rows = context(spark, sf_dir, dt.date(2001, 8, 5)).source("copied_table")
    tables.ingest(rows, f"{database}.landing", "truncate", "ingest_at")
    landed = spark.table(f"{database}.landing").drop("part_ingest_at")
    ctx = context(spark, sf_dir, dt.date(2001, 8, 5), database)
    landed = landed.withColumn("ingest_cycle", F.col("ingest_cycle").cast("int"))
    ctx.sources = ChainMap({"copied_table": landed}, ctx.sources)
    for _ in range(2):
        run(ctx, "copied_table")
    return ctx.target("copied_table").drop("part_ingest_at")


@query("i19_seed", "SELECT n_nationkey, n_name, CAST(n_regionkey AS INTEGER) AS n_regionkey, c AS customers FROM nation JOIN (SELECT c_nationkey, count(*) AS c FROM customer GROUP BY 1) ON c_nationkey = n_nationkey")
def seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{scratch_database(spark)}.seed"
    nation = table(spark, sf_dir, "nation")
    path = tables.export(nation, scratch_path(spark, "seed"), "nation", "csv")
    tables.seed(spark, path, name, nation.schema)
    customers = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey"))
    return spark.table(name).join(customers.agg(F.count(F.lit(1)).alias("customers")), "n_nationkey")
