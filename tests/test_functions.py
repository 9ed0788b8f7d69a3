"""Small cases for column builders and names."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, jsonpath, names, text
from ledgerloom.functions.cases import bucket, case_when, null_if
from ledgerloom.plans.marts import BANDS, BAND_BOUNDS, FREQUENCY, MONETARY, frequency_rank, monetary_rank, tier_label

USD = [-1.0, 0.0, 0.5, 0.51, 1.0, 2.0, 5.0, 10.0, 10.01, None]


def values(spark, data, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*cols).collect()]


def test_tiers(spark):
    def expected(usd, n):
        tester = n == 1 and usd is not None and usd <= 0.5
        money = 0 if usd is None else next((r for r, b in ((2, 1), (3, 2), (4, 5), (5, 10)) if usd <= b), 6)
        often = 2 if n == 1 else next((r for r, b in ((3, 3), (4, 7), (5, 10)) if n <= b), 6)
        return (1, 1) if tester else (money, often)

    data = [(u, n) for u in USD for n in (0, 1, 2, 3, 4, 7, 8, 10, 11)]
    usd, n = F.col("usd"), F.col("n")
    got = values(spark, data, "usd double, n long", monetary_rank(usd, n), frequency_rank(usd, n))
    assert got == [expected(u, c) for u, c in data]


def test_tier_labels(spark):
    got = values(spark, [(i,) for i in (0, 1, 6, None)], "r int", tier_label(F.col("r"), MONETARY), tier_label(F.col("r"), FREQUENCY))
    assert got == [("others", "others"), (MONETARY[0], FREQUENCY[0]), (MONETARY[5], FREQUENCY[5]), (None, None)]


def test_amount_bands(spark):
    got = values(spark, [(u,) for u in USD], "usd double", bucket(F.col("usd"), BAND_BOUNDS, BANDS, "others"))
    assert [g[0][:3] for g in got] == ["N01", "N01", "N01", "N02", "N02", "N03", "N04", "N05", "N06", "oth"]


def test_case_falls_through_null(spark):
    col = case_when([(F.col("x") > 1, F.lit("a")), (F.lit(True), F.lit("b"))], F.lit("c"))
    assert values(spark, [(2,), (None,)], "x int", col) == [("a",), ("b",)]
    assert values(spark, [(None,)], "x int", null_if(F.col("x") > 1, F.lit("kept"))) == [("kept",)]


def test_like_wildcard(spark):
    got = values(spark, [("abcd_1",), ("abcdax",), ("abcd",), (None,)], "s string", F.col("s").like("abcd_%"))
    assert got == [(True,), (True,), (False,), (None,)]


JSON = ['{"a":"x"}', '{"a":5}', '{"a":true}', '{"a":{"b":1}}', '{"a":[1]}', '{"a":null}', "{}", "bad", None, '{"a":"{x}"}']


def test_json_readers(spark):
    data = [(j,) for j in JSON]
    scalar = [v[0] for v in values(spark, data, "j string", jsonpath.json_scalar(F.col("j"), "$.a"))]
    assert scalar == ["x", "5", "true", None, None, None, None, None, None, "{x}"]
    string = [v[0] for v in values(spark, data, "j string", jsonpath.json_string(F.col("j"), "a"))]
    assert string == ["x", "", "", "", "", "", "", "", "", "{x}"]
    first = '[{"slug":"p1"},{"slug":"p2"}]'
    assert values(spark, [(first,)], "j string", jsonpath.json_scalar(F.col("j"), "$[0].slug")) == [("p1",)]
    assert values(spark, [('{"$os":"ios"}',)], "j string", jsonpath.json_string(F.col("j"), "$os")) == [("ios",)]


def test_text(spark):
    def one(col, value):
        return values(spark, [(value,)], "s string", col(F.col("s")))[0][0]

    assert one(text.remove_accents, "Đặng Thị Ngọc ñç") == "Dang Thi Ngoc ñç"
    assert one(text.strip_symbols, "a-b c\té!9") == "ab c\t9"
    assert one(text.clean_text, 'a\r\nb"c₫') == "a bc"
    assert one(text.extract_email, "to: Jo <jo.x+1@mail.example.org>, z@y.io") == "jo.x+1@mail.example.org"
    assert one(text.extract_email, "nobody") is None
    assert one(lambda c: text.contains_words(c, ["price", "idr"]), "The PRICE, please") is True
    assert one(lambda c: text.contains_words(c, ["price"]), "priceless") is False
    assert one(lambda c: text.contains_words(c, ["que"]), "é que") is True
    assert one(lambda c: text.replace_chars(c, {"a": "b", "b": "", "c": "xyz"}), "abc") == "bxyz"
    assert one(text.sheet_id, "https://x/d/abc/edit") == "abc"
    assert one(text.sheet_id, "https://x/d/abc") == "abc"
    assert one(text.sheet_id, "https://x") is None


@pytest.mark.parametrize(
    "url, expected",
    [
        ("https://docs.google.com/document/d/A1/edit?x=1", "A1"),
        ("https://docs.google.com/document/d/A1?x=1", "A1"),
        ("https://drive.google.com/file/d/A1", "A1"),
        ("https://drive.google.com/drive/folders/F1?usp=x", "F1"),
        ("https://drive.google.com/drive/u/0/folders/F2", "F2"),
        ("https://drive.google.com/drive/shared-drives/S1", "S1"),
        ("https://drive.google.com/drive/u/12/shared-drives/S2?x", "S2"),
        ("https://script.google.com/home/projects/P1/edit", "P1"),
        ("https://example.com/A1", None),
    ],
)
def test_document_id(spark, url, expected):
    assert values(spark, [(url,)], "u string", text.document_id(F.col("u"))) == [(expected,)]


def test_join_items(spark):
    got = values(spark, [([1, None, 3],)], "a array<int>", text.join_items(F.col("a"), ", ", "'"))
    assert got == [("'1', 'None', '3'",)]


def test_column_names(spark):
    given = ["", "A b", "1st", "Số tiền (%)", "a b", "R&D.x", "a b", "n1st", "$x-y:"]
    expected = ["blank", "a_b", "n1st", "so_tien_percent", "a_b_2", "randd_x", "a_b_3", "n1st_2", "xy"]
    assert names.unique_names([names.standard_name(n) for n in given]) == expected
    assert names.standardize_columns(spark.createDataFrame([(1, 2)], ["A b", "a b"])).columns == ["a_b", "a_b_2"]


def test_mail_dates(spark):
    data = [("Mon, 5 Feb 2024 23:10:00 -0500 (EST)",), ("5 Feb 2024 01:00:00 +0530",), ("soon",), (None,)]
    got = [v[0] for v in values(spark, data, "s string", dates.to_gmt7(F.col("s")))]
    assert got == ["Tue, 06 Feb 2024 11:10:00", "Mon, 05 Feb 2024 02:30:00", None, None]


def test_months_apart_counts_boundaries(spark):
    got = values(spark, [(dt.date(2025, 2, 1), dt.date(2025, 1, 31))], "a date, b date", dates.months_apart(F.col("a"), F.col("b")))
    assert got == [(1,)]


def test_date_spine(spark):
    up = dates.date_spine(spark, dt.date(2024, 1, 1), dt.date(2024, 4, 1), 1, "months")
    assert [r[0] for r in up.collect()] == [dt.date(2024, m, 1) for m in (1, 2, 3, 4)]
    down = dates.date_spine(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 20), 1, "weeks", ascending=False)
    assert [r[0] for r in down.collect()] == ["2024-01-20", "2024-01-13", "2024-01-06"]
    open_ended = dates.date_spine(spark, dt.date(2024, 1, 1), None, 2, "days")
    assert [r[0] for r in open_ended.collect()] == [dt.date(2024, 1, 1), dt.date(2024, 1, 3)]
    assert dates.date_spine(spark, dt.date(2024, 1, 2), dt.date(2024, 1, 1)).count() == 0


def test_month_windows():
    windows = dates.month_windows(dt.date(2025, 1, 1), dt.date(2025, 6, 1))
    assert len(windows) == 5 and windows[0] == (dt.date(2025, 1, 1), dt.date(2025, 2, 1))
    assert dates.month_windows(dt.date(2025, 1, 1), dt.date(2025, 1, 1)) == []
    assert dates.month_windows(dt.date(2024, 1, 31), dt.date(2024, 3, 1)) == [(dt.date(2024, 1, 31), dt.date(2024, 2, 29))]
    recent = dates.refresh_windows(dt.date(2025, 3, 15))
    assert recent[0][0] == dt.date(2024, 11, 1) and recent[-1][1] == dt.date(2025, 4, 1) and len(recent) == 5
    assert dates.refresh_windows(dt.date(2022, 2, 9), backfill=True)[0][0] == dt.date(2022, 1, 1)


def test_now_text(spark):
    now = dt.datetime(2024, 2, 29, 18, 30, 5)
    row = spark.range(1).select(*[dates.now_text(k, now) for k in ("date", "time", "datetime", "?")]).first()
    assert tuple(row) == ("2024-03-01", "T01:30:05", "2024-03-01T01:30:05", "2024-03-01T01:30:05")
