"""Pages, messages and keyword flags (T rows of the inventory)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog import query, table
from ledgerloom.operators import messages, pages
from ledgerloom.operators.numbering import number_rows


@query(
    "t01_page_links",
    """
SELECT url AS source, regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) || link AS link FROM (
  SELECT url, unnest(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'g'),
    '(?is)<a\\s[^>]*\\bhref="([^"]*)"', 1)) AS link FROM pages)
WHERE regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) || link <> 'http://ththre.example.com/and'
""",
)
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_links(table(spark, sf_dir, "pages"), exclude=["http://ththre.example.com/and"])


@query(
    "t02_page_records",
    """
SELECT 'https://shop.example/' || p_partkey AS url, p_brand AS "Brand", CAST(p_size AS VARCHAR) AS "Size",
  CASE WHEN p_size > 25 THEN p_type || ' & co' END AS "Kind",
  CASE WHEN p_type <> 'PROMO' THEN 'Area ' || p_type END AS district, CASE WHEN p_size < 40 THEN p_name || ', ' || p_size END AS address
FROM part
""",
)
def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as web pages, and read back from them."""
    part, size = table(spark, sf_dir, "part"), F.col("p_size").cast("string")

    def item(title: str, value):
        return F.concat(
            F.lit(f'<div class="spec item"><span class="t">{title}</span><br><span class="v">'), value, F.lit("</span></div>")
        )

    kind = F.when(F.col("p_size") > 25, item("Kind", F.concat("p_type", F.lit(" &amp; co")))).otherwise(
        F.lit('<div class="item"><span class="t">Kind</span></div>')
    )
    crumbs = F.concat(
        F.lit('<a class="crumb" level="1">Home</a>'),
        F.when(F.col("p_type") != "PROMO", F.concat(F.lit('<a class="crumb" level="3">Area '), "p_type", F.lit("</a>"))).otherwise(
            F.lit("")
        ),
        F.lit('<a class="crumb" level="4">Rest</a>'),
    )
    address = F.when(
        F.col("p_size") < 40, F.concat(F.lit('<p class="addr"><b>'), "p_name", F.lit("</b>, "), size, F.lit("</p>"))
    ).otherwise(F.lit(""))
    html = F.concat(F.lit("<html><body>"), crumbs, item("Brand", F.col("p_brand")), item("Size", size), kind, address, F.lit("</body></html>"))
    made = part.select(
        F.concat(F.lit("https://shop.example/"), F.col("p_partkey").cast("string")).alias("url"), html.alias("html")
    )
    return pages.details_to_columns(pages.page_records(made, "item", "t", "v", "crumb", "addr"), ["Brand", "Size", "Kind"])


def _mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment notifications of three senders, one message per order, as raw bytes."""
    orders = table(spark, sf_dir, "orders")
    status, low = F.col("o_orderstatus"), F.col("o_orderpriority") == "5-LOW"
    amount = F.format_number(F.round("o_totalprice").cast("bigint"), 0)
    sender = (
        F.when(low, "news@example.com")
        .when(status == "F", "alerts@citibank.com.vn")
        .when(status == "O", "info@vib.com.vn")
        .otherwise("info@myvib.vib.com.vn")
    )
    row = F.when(F.col("o_orderpriority") == "1-URGENT", "So tien thanh toan").otherwise("Số tiền")
    html = (
        F.when(status == "F", F.concat(F.lit("<html><body><p>Giao dịch VND"), amount, F.lit(" tại cửa hàng</p></body></html>")))
        .when(status == "O", F.concat(F.lit("<div>Thẻ tín dụng</div><div>Giá trị: <b>"), amount, F.lit(" VND</b></div>")))
        .otherwise(F.concat(F.lit("<table><tr><td>"), row, F.lit("</td><td>"), amount, F.lit("</td></tr></table>")))
    )
    head = F.concat(
        F.lit("From: Bank <"), sender, F.lit(">\r\nSubject: Notice "), F.col("o_orderkey").cast("string"),
        F.lit("\r\nDate: "), F.date_format("o_orderdate", "EEE, d MMM yyyy HH:mm:ss"), F.lit(" +0000\r\n"),
    )
    single = F.concat(F.lit("Content-Type: text/html; charset=utf-8\r\nContent-Transfer-Encoding: 8bit\r\n\r\n"), html)
    mixed = F.concat(
        F.lit('Content-Type: multipart/mixed; boundary="xx"\r\n\r\n--xx\r\n'), single,
        F.lit("\r\n--xx\r\nContent-Type: text/plain\r\nContent-Disposition: attachment\r\n\r\nVND9,999\r\n--xx--\r\n"),
    )
    raw = F.concat(head, F.when(F.col("o_orderpriority") == "2-HIGH", mixed).otherwise(single))
    return orders.select(F.col("o_orderkey").alias("id"), F.encode(raw, "utf-8").alias("raw"))


SENDER = """CASE WHEN o_orderpriority = '5-LOW' THEN 'news@example.com' WHEN o_orderstatus = 'F' THEN 'alerts@citibank.com.vn'
  WHEN o_orderstatus = 'O' THEN 'info@vib.com.vn' ELSE 'info@myvib.vib.com.vn' END"""
SENT = "strftime(o_orderdate + INTERVAL 7 HOUR, '%a, %d %b %Y %H:%M:%S')"
AMOUNT = "CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(round(o_totalprice) AS BIGINT) END"


@query(
    "t03_normalized_messages",
    f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id, 'Notice ' || o_orderkey AS subject, {SENDER} AS sender, {SENT} AS date_sent,
  CASE o_orderstatus WHEN 'F' THEN '<html><body><p>Giao dich VND' || a || ' tai cua hang</p></body></html>'
    WHEN 'O' THEN '<div>The tin dung</div><div>Gia tri: <b>' || a || ' VND</b></div>'
    ELSE '<table><tr><td>' || CASE WHEN o_orderpriority = '1-URGENT' THEN 'So tien thanh toan' ELSE 'So tien' END || '</td><td>' || a || '</td></tr></table>' END AS body
FROM (SELECT *, format('{{:,}}', CAST(round(o_totalprice) AS BIGINT)) AS a FROM orders)
""",
)
def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.normalize_messages(_mail(spark, sf_dir))


@query("t04_payment_amounts", f"SELECT CAST(o_orderkey AS VARCHAR) AS id, {SENDER} AS sender, {AMOUNT} AS amount FROM orders")
def payment_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = messages.normalize_messages(_mail(spark, sf_dir))
    return mail.select("id", "sender", messages.extract_amount(F.col("sender"), F.col("body")).alias("amount"))


@query(
    "t05_notification_log",
    f"""
WITH logged AS (SELECT o_orderkey FROM orders WHERE o_totalprice < 100000)
SELECT (SELECT count(*) FROM logged) + row_number() OVER (ORDER BY o_orderkey) AS row_number, CAST(o_orderkey AS VARCHAR) AS key_column,
  TIMESTAMP '2024-02-01 00:00:00' AS write_time, 'Notice ' || o_orderkey AS subject, {SENDER} AS sender, {SENT} AS date_sent, {AMOUNT} AS amount
FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P' AND o_orderkey NOT IN (SELECT o_orderkey FROM logged)
""",
)
def notification_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of small orders are in the log already."""
    small = table(spark, sf_dir, "orders").where("o_totalprice < 100000")
    logged = number_rows(small.select(F.col("o_orderkey").cast("string").alias("key_column")), ["key_column"])
    mail = messages.normalize_messages(_mail(spark, sf_dir))
    senders = ["alerts@citibank.com.vn", "info@vib.com.vn"]
    return messages.notification_log(mail, senders, None, logged, dt.datetime(2024, 2, 1))


@query(
    "t05_newest_notifications",
    f"""
SELECT row_number() OVER (ORDER BY o_orderkey) AS row_number, CAST(o_orderkey AS VARCHAR) AS key_column,
  TIMESTAMP '2024-02-01 00:00:00' AS write_time, 'Notice ' || o_orderkey AS subject, {SENDER} AS sender, {SENT} AS date_sent, {AMOUNT} AS amount
FROM (SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 1000) WHERE o_orderpriority <> '5-LOW' AND o_orderstatus = 'F'
""",
)
def newest_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first log is written from the newest thousand messages: that limit is the step itself."""
    mail = messages.normalize_messages(_mail(spark, sf_dir))
    return messages.notification_log(mail, ["alerts@citibank.com.vn"], 1000, None, dt.datetime(2024, 2, 1))


@query(
    "t06_keyword_flag",
    "SELECT source, bool_or(regexp_matches(lower(text), '\\bnicht\\b|\\bwas\\b')) AS has_words FROM documents GROUP BY source",
)
def keyword_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.keyword_flag(table(spark, sf_dir, "documents"), "source", "text", ("nicht", "was"), "has_words")


@query(
    "t06_keyword_table",
    r"""
WITH words AS (SELECT DISTINCT w FROM (
    SELECT regexp_extract(lower(text), '^[a-z]{6,} ') AS w FROM benchmark UNION ALL SELECT regexp_extract(lower(text), '^[a-z]+ [a-z]+') FROM benchmark
    UNION ALL SELECT regexp_extract(lower(text), '[a-z]+[.] [a-z]+') FROM benchmark) WHERE w <> '')
SELECT doc_id, bool_or(text IS NOT NULL AND regexp_matches(lower(text), '\b' || replace(rtrim(w), '.', '\.') || '\b')) AS has_words FROM documents, words GROUP BY doc_id
""",
)
def keyword_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, phrases and ends of sentences that open the benchmark's items, looked for in every document."""
    items = table(spark, sf_dir, "benchmark").select(F.lower("text").alias("t"))
    shapes = ("^[a-z]{6,} ", "^[a-z]+ [a-z]+", "[a-z]+[.] [a-z]+")
    words = items.select(F.explode(F.array(*[F.rtrim(F.regexp_extract("t", s, 0)) for s in shapes])).alias("word"))
    return messages.keyword_flags(table(spark, sf_dir, "documents"), "doc_id", "text", words, "has_words")
