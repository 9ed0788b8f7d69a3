"""Data tests (Q rows of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog import query, table
from ledgerloom.operators import checks


@query(
    "q01_check_report",
    """
SELECT 'name present' AS "check", (SELECT count(*) FROM customer WHERE c_name IS NULL) AS violations, (SELECT count(*) FROM customer WHERE c_name IS NULL) = 0 AS passed
UNION ALL SELECT 'part names unique', n, n = 0 FROM (SELECT count(*) AS n FROM (SELECT p_name FROM part GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'some line has no order', 1, false
""",
)
def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_report(
        {
            "name present": checks.expect_not_null(table(spark, sf_dir, "customer"), "c_name"),
            "part names unique": checks.expect_unique(table(spark, sf_dir, "part"), "p_name"),
            "some line has no order": checks.expect_some_null(table(spark, sf_dir, "lineitem"), "l_orderkey"),
        }
    )


@query(
    "q01_report_of_one_scan",
    """
WITH t AS (SELECT *, CASE WHEN o_totalprice > 100000 THEN o_custkey END AS buyer FROM orders)
SELECT unnest(['key present', 'buyer present', 'key unique', 'buyer and status unique', 'some buyer is missing', 'price above 1000', 'comment not blank']) AS "check", unnest(v) AS violations, unnest(v) = 0 AS passed
FROM (SELECT [count(*) FILTER (o_orderkey IS NULL), count(*) FILTER (buyer IS NULL), count(o_orderkey) - count(DISTINCT o_orderkey),
  count(*) FILTER (buyer IS NOT NULL AND o_orderstatus IS NOT NULL) - count(DISTINCT CASE WHEN buyer IS NOT NULL THEN buyer || ':' || o_orderstatus END),
  CASE WHEN count(*) FILTER (buyer IS NULL) = 0 THEN 1 ELSE 0 END, count(*) FILTER (NOT coalesce(o_totalprice > 1000, false)),
  CASE WHEN count(*) FILTER (o_orderpriority <> '') = 0 THEN 1 ELSE 0 END] AS v FROM t)
""",
)
def report_of_one_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    buyer = F.when(F.col("o_totalprice") > 100000, F.col("o_custkey"))
    return checks.table_report(
        table(spark, sf_dir, "orders").withColumn("buyer", buyer),
        {
            "key present": checks.nulls("o_orderkey"),
            "buyer present": checks.nulls("buyer"),
            "key unique": checks.surplus("o_orderkey"),
            "buyer and status unique": checks.surplus(["buyer", "o_orderstatus"]),
            "some buyer is missing": checks.no_null("buyer"),
            "price above 1000": checks.broken(F.col("o_totalprice") > 1000),
            "comment not blank": checks.all_blank(["o_orderpriority"]),
        },
    )


NULLABLE = "(SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN o_custkey END AS buyer FROM orders)"


def _nullable(spark: SparkSession, sf_dir: str) -> DataFrame:
    buyer = F.when(F.col("o_totalprice") > 100000, F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", buyer.alias("buyer"))


@query(
    "q02_some_null",
    f"""
SELECT 'buyer' AS col, 1 AS violation FROM {NULLABLE} HAVING count(*) = count(buyer)
UNION ALL SELECT 'o_orderkey', 1 FROM {NULLABLE} HAVING count(*) = count(o_orderkey)
""",
)
def some_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _nullable(spark, sf_dir)
    found = [checks.expect_some_null(rows, c).select(F.lit(c).alias("col"), "violation") for c in ("buyer", "o_orderkey")]
    return found[0].unionByName(found[1])


@query("q03_not_null", f"SELECT * FROM {NULLABLE} WHERE buyer IS NULL")
def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.expect_not_null(_nullable(spark, sf_dir), "buyer")


@query("q04_unique", f"SELECT buyer, count(*) AS n FROM {NULLABLE} WHERE buyer IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.expect_unique(_nullable(spark, sf_dir), "buyer")


@query(
    "q05_blank",
    "SELECT 'filled' AS name, count(c_name) = 0 AS is_blank FROM customer UNION ALL SELECT 'blank', count(nullif(trim(replace(c_mktsegment, c_mktsegment, '')), '')) = 0 FROM customer",
)
def blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    empty = customers.select(F.replace("c_mktsegment", F.col("c_mktsegment"), F.lit("")).alias("x"), F.lit(None).alias("y"))
    parts = [checks.is_blank(df).select(F.lit(n).alias("name"), "is_blank") for n, df in (("filled", customers), ("blank", empty))]
    return parts[0].unionByName(parts[1])
