"""Spread joins give what plain joins give, and spread what they should spread."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators.joins import even_join, heavy_keys, spread_join
from ledgerloom.operators.sets import anti, semi, sym_diff, union_new
from ledgerloom.operators.windows import any_in_group, latest_per_key, net_equals

keys = st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=30)


def frame(spark, values, name):
    rows = [(k, i) for i, k in enumerate(values)]
    return spark.createDataFrame(rows, f"k int, {name} int")


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot", ["left", "right", "both"])
@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=keys, right=keys)
def test_spread_join_equals_plain_join(spark, rows, how, hot, null_safe, left, right):
    a, b = frame(spark, left, "x"), frame(spark, right, "y")
    on = a.k.eqNullSafe(b.k) if null_safe else a.k == b.k
    plain = a.join(b, on, how)
    plain = plain.select(a.k, "x") if how.startswith("left_") else plain.select(a.k, "x", "y")
    ours = spread_join(a, b, "k", how, hot=hot, null_safe=null_safe, rows_per_slice=2)
    assert rows(ours) == rows(plain)


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_even_join_equals_plain_join(spark, rows, how, null_safe):
    a, b = frame(spark, [1, 1, None, 2, 5], "x"), frame(spark, [1, None, 3, 5], "y")
    on = a.k.eqNullSafe(b.k) if null_safe else a.k == b.k
    plain = a.join(b, on, how)
    plain = plain.select(a.k, "x") if how.startswith("left_") else plain.select(a.k, "x", "y")
    assert rows(even_join(a, b, "k", how, null_safe)) == rows(plain)


@pytest.mark.parametrize("how", ["left", "left_semi"])
def test_adaptive_planner_splits_a_heavy_key_of_an_even_join(spark, how):
    """A third of the rows on one key, a third without a key; the right side is an aggregate on the key."""
    third = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id"))
    df = spark.range(0, 60000, 1, 8).select(third.alias("k"), F.col("id").alias("x"))
    totals = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    tight = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    }
    for name, value in tight.items():
        spark.conf.set(name, value)
    try:
        joined = even_join(df, totals, "k", how, null_safe=how == "left_semi")
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in tight:
            spark.conf.unset(name)
    assert "skew=true" in plan


def test_heavy_keys_are_few_and_counted(spark, rows):
    df = frame(spark, [1] * 10 + [2] * 3 + list(range(10, 20)), "x")
    assert rows(heavy_keys(df, ["k"], 2)) == [(1, 5), (2, 2)]


def test_hot_key_is_spread_over_tasks(spark):
    """A third of the rows on one key, a third without a key: no task gets a third of the rows."""
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("k"), F.col("id").alias("x")
    )
    dim = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = spread_join(df, dim, "k", "left", rows_per_slice=500)
        sizes = Counter(r[0] for r in joined.select(F.spark_partition_id(), "n").collect())
        plain = df.join(dim, "k", "left")
        plain_sizes = Counter(r[0] for r in plain.select(F.spark_partition_id(), "n").collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes.values()) == 30000
    assert max(plain_sizes.values()) > 10000
    assert max(sizes.values()) < 7000


def test_latest_per_key_cuts_rows_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (2, 5, 1)], "k int, v int, t int")
    plan = latest_per_key(df, "k", "v", "t")._jdf.queryExecution().executedPlan().toString()
    before = plan.split("Exchange")[-1]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_latest_per_key_ties_and_nulls(spark, rows):
    df = spark.createDataFrame([(1, 1, 3), (1, 1, 2), (2, None, 1), (2, 0, 1), (None, 4, 1), (None, 5, 1)], "k int, v int, t int")
    assert rows(latest_per_key(df, "k", "v", "t")) == [(1, 1, 2), (2, 0, 1), (None, 5, 1)]


def test_any_in_group(spark, rows):
    df = spark.createDataFrame([(1, "REFUNDED"), (1, "CHARGED"), (2, None), (None, "REFUNDED")], "k int, s string")
    flagged = any_in_group(df, "k", F.col("s") == "REFUNDED", "hit")
    assert rows(flagged) == [(1, "CHARGED", True), (1, "REFUNDED", True), (2, None, False), (None, "REFUNDED", True)]


def test_net_equals(spark, rows):
    data = [("a", "C"), ("b", "C"), ("b", "R"), ("c", "C"), ("c", "C"), ("d", "R"), ("e", "C"), ("e", "C"), ("e", "R"), (None, "C")]
    df = spark.createDataFrame(data, "k string, s string")
    kept = net_equals(df, "k", F.col("s") == "R")
    assert Counter(r[0] for r in rows(kept)) == {"a": 1, "e": 3, None: 1}


def test_set_operations_keep_duplicates(spark, rows):
    a = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (2,), (3,), (3,)], "k int")
    empty = a.where("k < 0")
    assert rows(union_new(a, b, "k")) == [(1,), (1,), (2,), (3,), (3,)]
    assert rows(semi(b, a, "k")) == [(2,), (2,)]
    assert rows(anti(b, a, "k")) == [(3,), (3,)]
    assert rows(sym_diff(a, b, "k")) == [(1,), (1,), (3,), (3,)]
    assert rows(anti(b, empty, "k")) == rows(b)
    assert rows(semi(b, empty, "k")) == [] and rows(union_new(empty, b, "k")) == rows(b)
