"""Merges, snapshot differences and documented table kinds on small cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import incremental as inc
from ledgerloom.operators.numbering import number_rows

DAY = dt.date


def test_upsert_by_version(spark, rows):
    target = spark.createDataFrame([(1, 5, "t"), (2, 5, "t"), (3, 5, "t"), (4, 5, "t")], "k int, v int, s string")
    new = spark.createDataFrame([(2, 6, "n"), (3, 4, "n"), (4, 5, "n"), (9, 1, "n")], "k int, v int, s string")
    expected = [(1, 5, "t"), (2, 6, "n"), (3, 5, "t"), (4, 5, "n"), (9, 1, "n")]
    once = inc.upsert(target, new, "k", "v")
    assert rows(once) == expected
    assert rows(inc.upsert(once, new, "k", "v")) == expected
    assert rows(inc.upsert(target.where("k < 0"), new, "k", "v")) == rows(new)


def test_upsert_newest_insert(spark, rows):
    target = spark.createDataFrame([(1, "t"), (2, "t")], "k int, s string")
    new = spark.createDataFrame([(2, "n"), (3, "n")], "k int, s string")
    once = inc.upsert(target, new, "k")
    assert rows(once) == [(1, "t"), (2, "n"), (3, "n")]
    assert rows(inc.upsert(once, new, "k")) == rows(once)


def test_compact_is_idempotent(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "k int, v int")
    once = inc.compact(df, "k", "v")
    assert rows(once) == [(1, 2), (2, 1)] == rows(inc.compact(once, "k", "v"))


EDGE = "date_key date, owner_id int, follower_id int, followed_at timestamp_ntz, following_status boolean, is_auto_follow boolean"


def edge(day, owner, follower, status=True):
    return (day, owner, follower, dt.datetime.combine(day, dt.time(9)), status, False)


def test_edge_diff(spark, rows):
    now = dt.datetime(2024, 3, 10, 12)
    target = spark.createDataFrame(
        [edge(DAY(2024, 3, 1), 1, 1), edge(DAY(2024, 3, 1), 1, 2), edge(DAY(2024, 3, 1), 1, 3, False), edge(DAY(2024, 3, 1), 1, 5)], EDGE
    )
    latest = spark.createDataFrame(
        [edge(DAY(2024, 3, 1), 1, 1), edge(DAY(2024, 3, 9), 1, 4), edge(DAY(2024, 3, 2), 1, 6), edge(DAY(2024, 3, 9), 1, 5)], EDGE
    )
    got = {(r.follower_id, r.date_key, r.note) for r in inc.edge_diff(target, latest, now).collect()}
    # 1 is unchanged, 2 vanished, 3 had left before, 4 is new, 5 followed again later, 6 is new but too old to report
    assert got == {(2, DAY(2024, 3, 1), "unfollow"), (4, DAY(2024, 3, 9), "follow"), (5, DAY(2024, 3, 9), "follow")}
    assert inc.edge_diff(target.where("following_status"), target.where("following_status"), now).isEmpty()
    assert inc.edge_diff(target.where("owner_id < 0"), latest, now).count() == 2


DIM = "user_id int, alias string, is_allowed boolean, created_at date, last_updated_at date"


def test_dim_diff(spark):
    old, today = DAY(2024, 1, 1), DAY(2024, 3, 10)
    target = spark.createDataFrame(
        [(1, "a", True, old, old), (2, "b", False, old, old), (3, "c", True, old, old), (4, "d", True, DAY(2024, 3, 9), DAY(2024, 3, 9))], DIM
    )
    latest = spark.createDataFrame([(1, "a", True, today, today), (2, "b", True, today, today), (5, "e", True, today, today)], DIM)
    got = {(r.user_id, r.is_allowed, r.last_updated_at) for r in inc.dim_diff(target, latest, today).collect()}
    assert got == {(4, False, DAY(2024, 3, 9)), (5, True, today)}
    strict = {(r.user_id, r.is_allowed, r.last_updated_at) for r in inc.dim_diff(target, latest, today, strict=True).collect()}
    assert strict == {(2, True, today), (3, False, today), (4, False, today), (5, True, today)}


def test_scd2(spark, rows):
    target = spark.createDataFrame(
        [(1, "a", DAY(2024, 1, 1), None), (2, "b", DAY(2024, 1, 1), None), (3, None, DAY(2024, 1, 1), None), (1, "z", DAY(2023, 1, 1), DAY(2024, 1, 1))],
        "k int, v string, valid_from date, valid_to date",
    )
    new = spark.createDataFrame([(1, "a"), (2, "c"), (3, None), (4, "d")], "k int, v string")
    day = DAY(2024, 2, 1)
    once = inc.scd2(target, new, "k", day)
    assert {(r.k, r.v, r.valid_to) for r in once.collect()} == {
        (1, "a", None), (1, "z", DAY(2024, 1, 1)), (2, "b", day), (2, "c", None), (3, None, None), (4, "d", None),
    }
    assert rows(inc.scd2(once, new, "k", DAY(2024, 3, 1))) == rows(once)
    gone = inc.scd2(once, new.where("k = 1"), "k", DAY(2024, 3, 1), close_missing=True)
    assert gone.where("valid_to IS NULL").count() == 1


def test_states_with_sketch(spark):
    df = spark.createDataFrame([(k, d, d % 7) for k in (1, 2) for d in range(20)], "k int, d int, u int")
    finished = inc.finish_states(inc.merge_states(inc.agg_state(df, ["k", "d"], "d", "u"), "k"))
    assert {tuple(r) for r in finished.select("k", "n", "total", "low", "high", "mean", "distinct_estimate").collect()} == {
        (1, 20, 190, 0, 19, 9.5, 7), (2, 20, 190, 0, 19, 9.5, 7),
    }


def test_number_rows(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(7)
    numbered = number_rows(df, ["x"], start=5)
    assert all(r.row_number == r.x + 5 for r in numbered.collect())


def test_process_remaining(spark):
    now = dt.datetime(2024, 2, 1)
    inputs = spark.createDataFrame([(f"m{i}", i) for i in range(6)], "id string, n int")

    def work(df):
        return df.where("n != 3").select("id", (F.col("n") * 10).alias("result"))

    first = inc.process_remaining(inputs.where("n < 2"), None, work, "id", now, ["id"])
    log = [tuple(r) for r in first.collect()]
    assert [(r[0], r[1], r[3]) for r in sorted(log)] == [(1, "m0", 0), (2, "m1", 10)]
    again = inc.process_remaining(inputs, first, work, "id", now, ["id"])
    assert sorted((r.row_number, r.key_column) for r in again.collect()) == [(3, "m2"), (4, "m4"), (5, "m5")]
    done = inc.process_remaining(inputs, first.unionByName(again), work, "id", now, ["id"])
    assert done.isEmpty()


def test_collapse(spark, rows):
    df = spark.createDataFrame([(1, 1, 1), (1, 1, -1), (1, 2, 1), (2, 1, 1), (2, 1, -1)], "k int, v int, sign int")
    assert rows(inc.collapse(df, "k", "sign", "v")) == [(1, 2, 1)]
    assert rows(inc.collapse_versions(df, "k", "sign", "v")) == [(1, 2, 1)]


@pytest.mark.parametrize("days, grain", [(0, "minute"), (6, "minute"), (7, "hour"), (30, "day"), (900, "day")])
def test_rollup_by_age(spark, days, grain):
    ts = dt.datetime(2024, 6, 1, 13, 14, 15) - dt.timedelta(days=days)
    df = spark.createDataFrame([("m", ts, 2)], "name string, ts timestamp_ntz, v int")
    got = inc.rollup_by_age(df, "name", "ts", "v", [(0, "minute"), (7, "hour"), (30, "day")], DAY(2024, 6, 1)).first()
    assert (got.grain, got.n, got.total) == (grain, 1, 2)
