"""Every registered query against its SQL, on the smallest tables; and again with keys cut into tiny slices."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from ledgerloom.operators import joins

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
SPREADING = [n for n in QUERIES if n[:2] in ("j0", "j1", "u0", "w0") or n in ("m01_star_purchase", "m02_user_topup_transaction", "m09_latest_follow", "m13_content_access")]


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, connection, name):
    _, wrong = compare(spark, connection, QUERIES[name], ORACLE[name], FOLDER)
    assert not wrong


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


@pytest.mark.parametrize("name", sorted(SPREADING))
def test_same_rows_when_every_key_is_heavy(spark, connection, monkeypatch, name):
    monkeypatch.setattr(joins, "ROWS_PER_SLICE", 2)
    _, wrong = compare(spark, connection, QUERIES[name], ORACLE[name], FOLDER)
    assert not wrong


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "user_id"
