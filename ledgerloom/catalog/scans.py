"""Scans and loads (S rows of the inventory). Loads read files that Spark wrote from the provided tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog import query, table
from ledgerloom.catalog.roles import ROLES, context
from ledgerloom.operators.incremental import read_final
from ledgerloom.plans.registry import run
from ledgerloom.session import scratch_database, scratch_path
from ledgerloom.sources import readers, tables


@query("s01_table_scan", "SELECT * FROM orders")
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


@query(
    "s02_model_reference",
    ROLES + "SELECT consum_transaction_id, user_id FROM (SELECT CAST(id AS VARCHAR) AS consum_transaction_id, user_id FROM billing_ledger)",
)
def model_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = context(spark, sf_dir, dt.date(2001, 8, 5))
    return ctx.ref("daily_transaction").select("consum_transaction_id", "user_id")


@query("s03_stored_target", ROLES + "SELECT * FROM copied_table QUALIFY row_number() OVER (PARTITION BY creator_id, ingest_cycle ORDER BY ingest_at DESC, payout_id) = 1")
def stored_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = context(spark, sf_dir, dt.date(2001, 8, 5), scratch_database(spark))
    run(ctx, "copied_table")
    return ctx.target("copied_table").drop("part_ingest_at")


VERSIONED = """
WITH v AS (
  SELECT o_orderkey, o_totalprice, 1 AS version FROM orders
  UNION ALL SELECT o_orderkey, o_totalprice * 2, 2 FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT o_orderkey, o_totalprice * 3, 3 FROM orders WHERE o_orderstatus = 'F')
"""


def versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with altered copies under higher versions."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    copies = F.when(F.col("o_orderstatus") == "F", 3).when(F.col("o_orderstatus") == "O", 2).otherwise(1)
    rows = orders.withColumn("version", F.explode(F.sequence(F.lit(1), copies)))
    return rows.select("o_orderkey", (F.col("o_totalprice") * F.col("version")).alias("o_totalprice"), "version")


@query("s04_read_final", VERSIONED + "SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) = 1")
def merged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_final(versioned(spark, sf_dir), "o_orderkey", "version")


@query("s05_load_parquet", "SELECT * FROM lineitem")
def load_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{scratch_database(spark)}.lineitem"
    tables.load_parquet(spark, f"{sf_dir}/lineitem.parquet", name)
    return spark.table(name)


@query(
    "s06_load_csv",
    "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, c_acctbal < 0 AS in_debt FROM customer",
)
def load_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").withColumn("in_debt", F.col("c_acctbal") < 0)
    path = tables.export(customers, scratch_path(spark, "export"), "customers", "csv")
    return readers.load_csv(spark, path)


@query(
    "s07_load_csv_text",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders",
)
def load_csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"))
    path = tables.export(orders, scratch_path(spark, "export"), "orders", "csv")
    return readers.load_csv_text(spark, path)


@query(
    "s08_load_grid",
    """
SELECT CAST(c_custkey AS VARCHAR) AS "Customer, no.", c_name AS "Name",
  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS "Segment" FROM customer
""",
)
def load_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets with a title and a blank row above the names; every file that is written gets its own heading."""
    heading = ["All customers,,", ",,", '"Customer, no.",Name,Segment']
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).otherwise("")
    lines = table(spark, sf_dir, "customer").select(
        F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", segment).alias("value")
    )

    def with_heading(batches):
        import pandas as pd

        yield pd.DataFrame({"value": heading})
        yield from batches

    path = scratch_path(spark, "grid")
    lines.mapInPandas(with_heading, "value string").write.text(path)
    return readers.load_grid(spark, path, header_row=3)


@query(
    "s09_run_sql",
    "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderdate >= DATE '1998-01-01' GROUP BY o_orderpriority",
)
def run_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        SELECT o_orderpriority, count(*) AS n FROM parquet.`{}` WHERE o_orderdate >= :start GROUP BY ALL
    """.format(f"{sf_dir}/orders.parquet")
    return readers.run_sql(spark, text, args={"start": dt.date(1998, 1, 1)})


@query("s10_list_files", "SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def list_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partitions of a table stored by two columns, by the names of its files; no row of the copy is read."""
    path = scratch_path(spark, "parted")
    orders = table(spark, sf_dir, "orders").withColumn("both", F.concat_ws("+ /", "o_orderpriority", "o_orderstatus"))
    orders.write.partitionBy("both", "o_orderstatus").parquet(path)
    listed = readers.list_partitions(spark, path, "both")
    return listed.select(F.split("both", r"\+ /")[0].alias("o_orderpriority"), F.split("both", r"\+ /")[1].alias("o_orderstatus"))


@query(
    "s11_file_inventory",
    """
WITH files AS (
  SELECT doc_id AS seq, 'f' || doc_id AS file_id,
    CASE WHEN n_chars < 300 THEN 'results-' || n_chars || '-' || doc_id WHEN n_chars < 600 THEN 'Untitled spreadsheet (' || lang || ')'
      WHEN n_chars < 1200 THEN 'old results-1-2 ' || lang || '.xlsx' ELSE source || '-' || lang || '.pdf' END AS name,
    CASE WHEN lang = 'fr' THEN 'application/vnd.google-apps.document' ELSE 'application/octet-stream' END AS mime_type,
    lang <> 'es' AS owned, source = 'src3' AS trashed FROM documents)
SELECT name, arg_max(file_id, seq) AS file_id FROM files
WHERE (mime_type = 'application/vnd.google-apps.document' OR contains(name, '.xlsx') OR contains(name, '.pdf'))
  AND owned AND NOT trashed AND NOT regexp_matches(name, '^(results-\\d+-\\d+|Untitled spreadsheet|bq-results-\\d+-\\d+)')
GROUP BY name
""",
)
def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, doc = F.col("n_chars"), F.col("doc_id").cast("string")
    name = (
        F.when(size < 300, F.concat(F.lit("results-"), size.cast("string"), F.lit("-"), doc))
        .when(size < 600, F.concat(F.lit("Untitled spreadsheet ("), F.col("lang"), F.lit(")")))
        .when(size < 1200, F.concat(F.lit("old results-1-2 "), F.col("lang"), F.lit(".xlsx")))
        .otherwise(F.concat(F.col("source"), F.lit("-"), F.col("lang"), F.lit(".pdf")))
    )
    listing = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("seq"),
        F.concat(F.lit("f"), doc).alias("file_id"),
        name.alias("name"),
        F.when(F.col("lang") == "fr", readers.KEPT_KINDS[1]).otherwise("application/octet-stream").alias("mime_type"),
        (F.col("lang") != "es").alias("owned"),
        (F.col("source") == "src3").alias("trashed"),
    )
    return readers.file_inventory(listing)
