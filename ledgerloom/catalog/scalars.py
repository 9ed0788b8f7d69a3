"""Text, JSON and date functions (X and D rows of the inventory)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog import query, table
from ledgerloom.functions import dates, jsonpath, text
from ledgerloom.functions.names import standardize_columns

WORDS = ("the", "que", "und", "nicht")


@query(
    "x01_contains_words",
    "SELECT doc_id, regexp_matches(lower(text), '\\bthe\\b|\\bque\\b|\\bund\\b|\\bnicht\\b') AS found FROM documents",
)
def contains_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.contains_words(F.col("text"), WORDS).alias("found"))


@query(
    "x02_concat",
    "SELECT c_custkey, 'https://example.com/@' || CASE WHEN c_acctbal > 0 THEN c_name END AS page FROM customer",
)
def concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    slug = F.when(F.col("c_acctbal") > 0, F.col("c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", text.page_url("https://example.com/@", slug).alias("page"))


@query("x03_replace", "SELECT c_custkey, replace(c_name, 'Customer#', '') AS id FROM customer")
def replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.replace("c_name", F.lit("Customer#"), F.lit("")).alias("id"))


@query("x04_to_text", "SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id FROM orders")
def to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").cast("string").alias("user_id"))


@query(
    "x05_remove_accents",
    # The letters are written out here again, so that a fault in the table shows.
    """SELECT doc_id, translate(text, 'ÀÁÂÃÈÉÊÌÍÒÓÔÕÙÚÝàáâãèéêìíòóôõùúýĂăĐđĨĩŨũƠơƯưẠạẢảẤấẦầẨẩẪẫẬậẮắẰằẲẳẴẵẶặẸẹẺẻẼẽẾếỀềỂểỄễỆệỈỉỊịỌọỎỏỐốỒồỔổỖỗỘộỚớỜờỞởỠỡỢợỤụỦủỨứỪừỬửỮữỰựỲỳỴỵỶỷỸỹ', 'AAAAEEEIIOOOOUUYaaaaeeeiioooouuyAaDdIiUuOoUuAaAaAaAaAaAaAaAaAaAaAaAaEeEeEeEeEeEeEeEeIiIiOoOoOoOoOoOoOoOoOoOoOoOoUuUuUuUuUuUuUuYyYyYyYy') AS plain FROM documents""",
)
def remove_accents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.remove_accents(F.col("text")).alias("plain"))


@query(
    "x06_strip_symbols",
    "SELECT doc_id, regexp_replace(text, '[^a-zA-Z0-9\\t-\\r\\x1c-\\x1f\\x{85}\\pZ]', '', 'g') AS plain FROM documents",
)
def strip_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.strip_symbols(F.col("text")).alias("plain"))


@query(
    "x07_clean_text",
    """SELECT conv_id, turn, translate(text, chr(10) || chr(13) || '"₫', ' ') AS body FROM conversations""",
)
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.clean_text(F.col("text")).alias("body"))


@query(
    "x08_replace_chars",
    """
SELECT p_partkey, replace(replace(translate(p_name, 'ab ', 'ba'), 'e', 'EE'), 'o', '') AS name FROM part
""",
)
def replace_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = {"a": "b", "b": "a", " ": "", "e": "EE", "o": ""}
    return table(spark, sf_dir, "part").select("p_partkey", text.replace_chars(F.col("p_name"), mapping).alias("name"))


@query(
    "x09_extract_email",
    "SELECT doc_id, nullif(regexp_extract(text, '\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Z|a-z]{2,}\\b'), '') AS email FROM documents",
)
def extract_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.extract_email(F.col("text")).alias("email"))


LINKS = """
WITH links AS (SELECT page_id, CASE WHEN page_id < 20 THEN url
  WHEN contains(url, '/fr/') THEN 'https://docs.google.com/spreadsheets/d/sh' || page_id || '/edit#gid=0'
  WHEN contains(url, '/en/') THEN 'https://drive.google.com/drive/u/1/folders/fo' || page_id || '?usp=sharing'
  WHEN contains(url, '/de/') THEN 'https://docs.google.com/forms/d/fm' || page_id || '?x=1'
  WHEN contains(url, '/es/') THEN 'https://script.google.com/macros/s/sc' || page_id || '/exec'
  ELSE 'https://docs.google.com/document/d/dc' || page_id END AS link FROM pages)
"""


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page rows with a document link of one of several shapes."""
    page = F.col("page_id").cast("string")

    def shape(before: str, after: str = ""):
        return F.concat(F.lit(before), page, F.lit(after))

    def has(part: str):
        return F.contains("url", F.lit(part))

    link = (
        F.when(F.col("page_id") < 20, F.col("url"))
        .when(has("/fr/"), shape("https://docs.google.com/spreadsheets/d/sh", "/edit#gid=0"))
        .when(has("/en/"), shape("https://drive.google.com/drive/u/1/folders/fo", "?usp=sharing"))
        .when(has("/de/"), shape("https://docs.google.com/forms/d/fm", "?x=1"))
        .when(has("/es/"), shape("https://script.google.com/macros/s/sc", "/exec"))
        .otherwise(shape("https://docs.google.com/document/d/dc"))
    )
    return table(spark, sf_dir, "pages").select("page_id", link.alias("link"))


@query(
    "x10_sheet_id",
    LINKS + "SELECT page_id, CASE WHEN contains(link, '/d/') THEN split_part(split_part(link, '/d/', 2), '/', 1) END AS sheet FROM links",
)
def sheet_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(spark, sf_dir).select("page_id", text.sheet_id(F.col("link")).alias("sheet"))


@query(
    "x11_document_id",
    LINKS
    + """
SELECT page_id, CASE WHEN page_id < 20 THEN NULL WHEN contains(link, '/spreadsheets/') THEN 'sh' || page_id
  WHEN contains(link, '/u/1/folders/') THEN 'fo' || page_id WHEN contains(link, '/forms/') THEN 'fm' || page_id
  WHEN contains(link, 'script.google.com') THEN regexp_extract(link, 'script\\.google\\.com/[a-z/]+/([^/?]+)', 1)
  ELSE 'dc' || page_id END AS id FROM links
""",
)
def document_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(spark, sf_dir).select("page_id", text.document_id(F.col("link")).alias("id"))


@query(
    "x12_build_url",
    "SELECT 'https://docs.google.com/spreadsheets/d/' || doc_id || '/edit' AS url FROM documents",
)
def build_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(text.sheet_url(F.col("doc_id").cast("string")).alias("url"))


@query(
    "x13_join_items",
    """SELECT c_custkey, '"' || c_name || '"; "' || coalesce(CASE WHEN c_acctbal > 0 THEN c_mktsegment END, 'None') || '"' AS joined FROM customer""",
)
def join_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = F.array("c_name", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")))
    return table(spark, sf_dir, "customer").select("c_custkey", text.join_items(items, "; ", '"').alias("joined"))


@query(
    "x14_standardize_columns",
    """
SELECT c_custkey AS khach_hang_id, c_name AS ten_and_ho, c_acctbal AS "n2024_percent", c_mktsegment AS ten_and_ho_2, c_nationkey AS blank FROM customer
""",
)
def standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey")
    return standardize_columns(customers.toDF("Khách hàng.ID", "Tên & Họ", "2024 %", "tên & họ?", ""))


JSON_ROWS = """
WITH rows AS (SELECT event_id, CASE event_type
  WHEN 'view' THEN '{"a": "{text} ' || user_id || '", "l": [{"s": "p' || user_id || '"}]}'
  WHEN 'click' THEN '{"a": {"b": ' || user_id || '}, "l": []}' WHEN 'error' THEN '{"a": [1, 2], "l": [3]}'
  WHEN 'signup' THEN '{"a": ' || user_id || ', "l": [{"s": true}]}' ELSE 'not json ' || user_id END AS j FROM events)
"""


def _json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with JSON whose member ``a`` is a string, an object, an array or a number, or no JSON at all."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    j = (
        F.when(kind == "view", F.concat(F.lit('{"a": "{text} '), user, F.lit('", "l": [{"s": "p'), user, F.lit('"}]}')))
        .when(kind == "click", F.concat(F.lit('{"a": {"b": '), user, F.lit('}, "l": []}')))
        .when(kind == "error", F.lit('{"a": [1, 2], "l": [3]}'))
        .when(kind == "signup", F.concat(F.lit('{"a": '), user, F.lit(', "l": [{"s": true}]}')))
        .otherwise(F.concat(F.lit("not json "), user))
    )
    return table(spark, sf_dir, "events").select("event_id", j.alias("j"))


def _scalar_sql(path: str) -> str:
    return (
        f"CASE WHEN json_valid(j) THEN CASE WHEN json_type(j, '{path}') IN ('OBJECT', 'ARRAY') THEN NULL "
        f"ELSE json_extract_string(j, '{path}') END END"
    )


@query(
    "x15_json_scalar",
    JSON_ROWS + f"SELECT event_id, {_scalar_sql('$.a')} AS a, {_scalar_sql('$.l[0].s')} AS slug FROM rows",
)
def json_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _json_rows(spark, sf_dir).select(
        "event_id",
        jsonpath.json_scalar(F.col("j"), "$.a").alias("a"),
        jsonpath.json_scalar(F.col("j"), "$.l[0].s").alias("slug"),
    )


@query(
    "x16_json_value",
    "SELECT l_orderkey, l_linenumber, l_partkey, 'com.example.' || l_partkey AS product, CAST(l_quantity AS INTEGER) AS quantity FROM lineitem",
)
def json_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = F.concat(F.lit("com.example."), F.col("l_partkey").cast("string")).alias("productId")
    record = F.struct(product, F.struct(F.col("l_quantity").cast("int").alias("n")).alias("more"))
    lines = table(spark, sf_dir, "lineitem").withColumn("gateway_response", record)
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        jsonpath.json_value(F.col("gateway_response"), "$.productId").alias("product"),
        jsonpath.json_value(F.col("gateway_response"), "$.more.n").cast("int").alias("quantity"),
    )


@query(
    "x17_json_string",
    JSON_ROWS
    + "SELECT event_id, CASE WHEN json_valid(j) AND json_type(j, '$.a') = 'VARCHAR' THEN json_extract_string(j, '$.a') ELSE '' END AS a FROM rows",
)
def json_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _json_rows(spark, sf_dir).select("event_id", jsonpath.json_string(F.col("j"), "a").alias("a"))


@query(
    "x18_arithmetic",
    "SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) / -100 AS usd, -o_custkey AS minus, round(o_totalprice / 7, 2) AS part FROM orders",
)
def arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.round(price * 100).cast("bigint") / -100).alias("usd"),
        (-F.col("o_custkey")).alias("minus"),
        F.round(price / 7, 2).alias("part"),
    )


@query(
    "d01_d05_dates",
    """
SELECT event_id, CAST(ts AS DATE) AS day, ts AS at, CAST('2024-01-01 10:00:00' AS TIMESTAMP) AS fixed,
  CAST(CAST(ts AS DATE) AS TIMESTAMP) AS midnight, CAST(date_trunc('month', ts) AS DATE) AS month,
  CAST(year(ts) * 100 + month(ts) AS INTEGER) AS yyyymm FROM events
""",
)
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        dates.date_of(ts).alias("day"),
        dates.datetime_of(ts).alias("at"),
        dates.datetime_of(F.lit("2024-01-01 10:00:00")).alias("fixed"),
        dates.datetime_of(dates.date_of(ts)).alias("midnight"),
        dates.month_start(ts).alias("month"),
        dates.month_number(ts).alias("yyyymm"),
    )


@query(
    "d06_d08_month_distance",
    """
SELECT o_orderkey, CAST(date_diff('month', o_orderdate, DATE '2001-08-05') AS INTEGER) AS months,
  o_orderdate >= DATE '2001-08-05' - INTERVAL 1 MONTH AS last_month, o_orderdate >= DATE '2001-08-05' - 3 AS last_days,
  o_orderdate >= DATE '2001-06-01' AS whole_months, DATE '2001-08-05' AS today FROM orders
""",
)
def month_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of, day = dt.date(2001, 8, 5), F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.months_apart(F.lit(as_of), day).alias("months"),
        (day >= dates.back(as_of, 1, "months")).alias("last_month"),
        (day >= dates.back(as_of, 3, "days")).alias("last_days"),
        (day >= dates.back(as_of, 2, "whole_months")).alias("whole_months"),
        F.lit(as_of).alias("today"),
    )


@query(
    "d09_to_gmt7",
    """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE strftime(ts + to_minutes(CASE event_type WHEN 'view' THEN 720 WHEN 'click' THEN 90 ELSE 420 END),
  '%a, %d %b %Y %H:%M:%S') END AS local FROM events
""",
)
def to_gmt7(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    written = F.date_format("ts", "EEE, d MMM yyyy HH:mm:ss")
    sent = (
        F.when(kind == "view", F.concat(written, F.lit(" -0500 (EST)")))
        .when(kind == "click", F.concat(written, F.lit(" +0530")))
        .when(kind == "error", F.lit("yesterday"))
        .otherwise(F.concat(F.date_format("ts", "dd MMM yyyy HH:mm:ss"), F.lit(" +0000")))
    )
    return table(spark, sf_dir, "events").select("event_id", dates.to_gmt7(sent).alias("local"))


@query(
    "d10_now_text",
    """
SELECT c_custkey, '2024-03-01' AS day, 'T01:30:00' AS clock, '2024-03-01T01:30:00' AS stamp FROM customer
""",
)
def now_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = dt.datetime(2024, 2, 29, 18, 30)
    kinds = {"date": "day", "time": "clock", "datetime": "stamp"}
    return table(spark, sf_dir, "customer").select("c_custkey", *[dates.now_text(k, now).alias(a) for k, a in kinds.items()])


@query(
    "d11_date_spine",
    """
SELECT o_custkey, CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS DATE) AS month
FROM orders GROUP BY o_custkey
""",
)
def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month between a buyer's first and last order, with or without orders."""
    month = dates.month_start(F.col("o_orderdate"))
    spans = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min(month).alias("a"), F.max(month).alias("b"))
    return spans.select("o_custkey", F.explode(dates.spine_array(F.col("a"), F.col("b"), 1, "months")).alias("month"))


@query(
    "l03_descending_dates",
    """
SELECT o_custkey, strftime(unnest(generate_series(max(o_orderdate)::DATE, min(o_orderdate)::DATE, -INTERVAL 7 DAY)), '%Y-%m-%d') AS week
FROM orders GROUP BY o_custkey
""",
)
def descending_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks counted down from a buyer's last order to the first, as text."""
    day = F.to_date("o_orderdate")
    spans = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min(day).alias("a"), F.max(day).alias("b"))
    return spans.select("o_custkey", F.explode(dates.falling_text(F.col("a"), F.col("b"), 7, "days")).alias("week"))
