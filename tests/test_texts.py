"""Pages and messages."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import messages, pages

PAGE = """<html><!-- <a href="/hidden">x</a> --><script>var a = '<a href="/no">';</script>
<a class="card product" href="/p/1">One</a><a class='card' href='sub/2?a=1&amp;b=2'>Two</a>
<A HREF=//cdn.example.com/x>Three</A><a name="no-target">Four</a><a class="product" href="https://other.example/z">Five</a></html>"""


def page_frame(spark, html, url="https://example.com/list/page.html?x=1"):
    return spark.createDataFrame([(url, html)], "url string, html string")


def links(df):
    return [r.link for r in df.collect()]


def test_page_links(spark):
    df = page_frame(spark, PAGE)
    assert links(pages.page_links(df)) == [
        "https://example.com/p/1", "https://example.com/list/sub/2?a=1&b=2", "https://cdn.example.com/x", "https://other.example/z",
    ]
    assert links(pages.page_links(df, "product")) == ["https://example.com/p/1", "https://other.example/z"]
    assert links(pages.page_links(df, "product", ["https://other.example/z"])) == ["https://example.com/p/1"]
    assert links(pages.page_links(df, "card", absolute=False)) == ["/p/1", "sub/2?a=1&b=2"]


SPEC = """<div class="specs"><div class="item"><span class="t">Area</span><img src=x><span class="v">80 <b>m²</b></span></div>
<div class="item"><span class="t">No value</span></div><div class="item"><span class="t">Price &amp; tax</span><span class="v"> 5\n ty </span></div></div>
<a class="crumb" level="1">City</a><a class="crumb" level="3">First</a><a class="crumb" level="3">Second</a><p class="addr">Street <i>9</i></p>"""


def test_page_records(spark):
    record = pages.page_records(page_frame(spark, SPEC), "item", "t", "v", "crumb", "addr").first()
    assert record.details == {"Area": "80 m²", "Price & tax": "5 ty"}
    assert (record.district, record.address) == ("First", "Street 9")
    for html in ("", None, "<p>nothing", "<div class=item><span class=t>x"):
        empty = pages.page_records(page_frame(spark, html), "item", "t", "v", "crumb", "addr").first()
        assert (empty.details, empty.district, empty.address) == ({}, None, None)


def mail(*lines):
    return "\r\n".join(lines).encode()


PLAIN = mail("From: Ann <ann@example.com>", "Subject: Plain - subject!", "Date: Mon, 5 Feb 2024 01:00:00 +0000", "", 'Xin "chào"', "bạn ₫5")
ENCODED = mail("From: x@y.example", "Subject: =?utf-8?b?VGjDtG5nIGLDoW8h?=", "Date: someday", "", "x")
MIXED = mail(
    "From: z@y.example", "Subject: s", "Date: Mon, 5 Feb 2024 01:00:00 -0500", 'Content-Type: multipart/mixed; boundary="b"', "",
    "--b", "Content-Type: text/plain; charset=utf-8", "", "text ", "--b", "Content-Type: text/html", "", "<p>html</p>",
    "--b", "Content-Type: text/plain", "Content-Disposition: attachment", "", "secret", "--b--",
)


def test_normalize_messages(spark):
    df = spark.createDataFrame([(1, bytearray(PLAIN)), (2, bytearray(ENCODED)), (3, bytearray(MIXED))], "id long, raw binary")
    one, two, three = sorted(messages.normalize_messages(df).collect(), key=lambda r: r.id)
    assert tuple(one) == ("1", "Plain - subject!", "ann@example.com", "Mon, 05 Feb 2024 08:00:00", "Xin chao ban 5")
    assert (two.subject, two.date_sent) == ("Thong bao", "someday")
    assert "text" in three.body and "<p>html</p>" in three.body and "secret" not in three.body


def test_all_parts_of_an_encoded_subject(spark):
    raw = b"Subject: =?utf-8?Q?Giao_d?= plain =?utf-8?Q?_two?=\nFrom: a@b.c\n\nbody"
    df = spark.createDataFrame([("1", bytearray(raw))], "id string, raw binary")
    assert messages.normalize_messages(df).first().subject.split() == ["Giao", "d", "plain", "two"]


def test_odd_messages_do_not_stop_the_job(spark):
    odd = [b"", b"no headers at all", mail("Subject: =?x-none?q?a=ff?=", "Content-Type: text/plain; charset=x-none", "", "body")]
    df = spark.createDataFrame([(i, bytearray(m)) for i, m in enumerate(odd)], "id long, raw binary")
    got = sorted(messages.normalize_messages(df).collect(), key=lambda r: r.id)
    assert [r.sender for r in got] == [None, None, None] and got[2].body == "body"


@pytest.mark.parametrize(
    "sender, body, amount",
    [
        ("alerts@citibank.com.vn", "<p>paid VND1,234,567 at</p>", 1234567),
        ("alerts@citibank.com.vn", "<p>paid USD5</p>", None),
        ("info@vib.com.vn", "<div>The</div><div>Gia tri: <b>9,000 VND</b></div>", 9000),
        ("info@vib.com.vn", "<div>Gia tri: 9,000 VND</div>", None),
        ("info@myvib.vib.com.vn", "<table><tr><td>So tien</td><td>7,500</td></tr></table>", 7500),
        ("info@myvib.vib.com.vn", "<table><tr><td>Ma</td><td>1</td></tr> <tr><td>So tien thanh toan </td><td> 12</td></tr></table>", 12),
        ("other@example.com", "VND5", None),
        ("alerts@citibank.com.vn", None, None),
    ],
)
def test_extract_amount(spark, sender, body, amount):
    df = spark.createDataFrame([(sender, body)], "sender string, body string")
    assert df.select(messages.extract_amount(F.col("sender"), F.col("body"))).first()[0] == amount


def test_notification_log(spark):
    data = [(str(i), "s", "alerts@citibank.com.vn" if i % 2 else "news@x.example", "d", f"VND{i},000") for i in range(8, 13)]
    df = spark.createDataFrame(data, "id string, subject string, sender string, date_sent string, body string")
    now = dt.datetime(2024, 1, 1)
    first = messages.notification_log(df, ["alerts@citibank.com.vn"], 2, None, now)
    assert [(r.row_number, r.key_column, r.amount) for r in first.collect()] == [(1, "11", 11000)]
    rest = messages.notification_log(df, ["alerts@citibank.com.vn"], None, first, now)
    assert [(r.row_number, r.key_column) for r in rest.collect()] == [(2, "9")]


def test_keyword_flag(spark, rows):
    df = spark.createDataFrame([(1, "the PRICE is"), (1, "x"), (2, "priceless"), (3, None)], "owner int, text string")
    flagged = messages.keyword_flag(df, "owner", "text", ["price", "contact"], "hit")
    assert rows(flagged) == [(1, True), (2, False), (3, None)]
