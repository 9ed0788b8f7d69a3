"""The model registry, marts on small cases, and the shape of physical plans."""

import datetime as dt
from collections import ChainMap

import pytest
from pyspark.sql import functions as F

import ledgerloom.plans.marts  # noqa: F401
from ledgerloom.catalog import table
from ledgerloom.catalog.roles import context
from ledgerloom.operators.filters import date_slice
from ledgerloom.operators.joins import anti_before_first
from ledgerloom.plans import registry
from ledgerloom.plans.registry import Context, backfill, run, run_slice, select_models
from ledgerloom.sources import tables

FOLDER = "/root/testdata/sf0.001"
LEDGER = "date_key date, user_id int, type string, subtype string, transaction_id string, usd_amount double"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def payers(spark, data, as_of=dt.date(2024, 6, 15)):
    """A context whose payer ledger is given."""
    ctx = Context(spark, {}, as_of)
    ctx._built["monthly_pay_user"] = spark.createDataFrame(data, LEDGER)
    return ctx


def paid(day, user, transaction, usd):
    return (day, user, "topup", "p", transaction, usd)


def test_selection_and_order():
    names = [m.name for m in select_models()]
    assert names.index("star_purchase") < names.index("monthly_pay_user") < names.index("pay_user_master_data")
    assert {m.name for m in select_models("tag:merged")} == {
        "ledger_transaction", "daily_follower_following", "transfer_permission_history", "copied_table",
    }
    assert [m.name for m in select_models("path:sliced")] == ["slice_copy"]
    assert [m.name for m in select_models("copied_table")] == ["copied_table"]
    with pytest.raises(ValueError):
        select_models("color:red")


def test_folder_defaults_and_overrides():
    assert registry.MODELS["latest_follow"].materialized == "ephemeral"
    assert registry.MODELS["star_purchase"].materialized == "table"
    assert registry.MODELS["copied_table"].materialized == "incremental"


def test_segmentation_keeps_unknown_users_without_measures(spark):
    data = [paid(dt.date(2024, 5, 2), 1, "a", 0.5), paid(dt.date(2024, 5, 9), None, "b", 3.0), paid(None, 2, "c", 3.0)]
    got = {(r.user_id, r.date_key): (r.monthly_monetary_type, r.monthly_frequency_rank) for r in payers(spark, data).ref("monthly_segmentation").collect()}
    assert got == {(1, dt.date(2024, 5, 1)): ("N01. one_timer", 1), (None, dt.date(2024, 5, 1)): (None, None), (2, None): (None, None)}


def test_segmentation_equals_the_joined_form(spark, rows):
    """Months joined back to the ledger rows, as the definition says, give the same as the form without a join."""
    data = [paid(dt.date(2024, m, d), u, f"{m}{d}{u}", float(d)) for m in (1, 2) for d in (1, 5, 9) for u in (1, 2, None)]
    ctx = payers(spark, data)
    ledger = ctx.ref("monthly_pay_user").withColumn("date_key", F.trunc("date_key", "MM"))
    months = ctx.ref("monthly_segmentation")
    known = months.where("user_id IS NOT NULL AND date_key IS NOT NULL")
    joined = ledger.select("date_key", "user_id").join(known, ["date_key", "user_id"], "left").distinct()
    assert rows(joined.select(*months.columns)) == rows(months)


@pytest.mark.parametrize(
    "last, kind, label",
    [
        (dt.date(2024, 6, 1), "active", "N03. light_user"),
        (dt.date(2024, 4, 30), "active", "N03. light_user"),
        (dt.date(2024, 3, 31), "retired", "Z. retired_recently"),
        (dt.date(2024, 2, 29), "retired", "Z. retired_long_ago"),
    ],
)
@pytest.mark.parametrize("as_of", [dt.date(2024, 6, 1), dt.date(2024, 6, 30)])
def test_flagging_by_whole_months(spark, as_of, last, kind, label):
    data = [paid(last, 1, "a", 2.0), paid(dt.date(2023, 1, 1), 1, "b", 50.0)]
    row = payers(spark, data, as_of).ref("pay_user_flagging").first()
    assert (row.pay_user_type, row.current_monetary_type, row.latest_active_monetary_type) == (kind, label, "N03. light_user")
    assert row.nearest_active_month == last.replace(day=1)
    assert row.current_monetary_rank == (3 if kind == "active" else 0)


def test_master_keeps_rows_without_user_or_date(spark):
    data = [paid(dt.date(2024, 6, 2), 1, "a", 2.0), paid(None, 1, "b", 0.2), paid(dt.date(2024, 6, 2), None, "c", 99.0), paid(dt.date(2024, 6, 2), 7, "d", None)]
    ctx = payers(spark, data)
    profile = "user_id int, user_alias string, suspended_at date, suspend_reason string, country string, email_domain string, provider string, preferred_os_system string, is_suspicious_user boolean, is_sus_social boolean, is_suspicious_x_social boolean, analytics_user_contry_code string"
    ctx.sources = {"user_master": spark.createDataFrame([(1, "ann", None, None, "VN", None, None, None, None, None, True, None)], profile)}
    got = {r.transaction_id: r for r in ctx.ref("pay_user_master_data").collect()}
    assert len(got) == 4
    assert (got["a"].pay_user_type, got["a"].monthly_usd_amount, got["a"].user_alias) == ("active", 2.0, "ann")
    assert (got["b"].pay_user_type, got["b"].monthly_usd_amount, got["b"].is_suspicious_social) == ("active", None, True)
    assert got["c"].pay_user_type is None and got["c"].transaction_amount_group == "N06. > 10.00 usd"
    assert got["d"].transaction_amount_group == "others"


def test_follower_history_reaches_a_fixed_point(spark, database):
    day = dt.date(2024, 1, 31)
    name = f"{database}.daily_follower_following"
    run(context(spark, FOLDER, day, database), "daily_follower_following")
    known = spark.table(name).where("owner_id IS NOT NULL").count()
    run(context(spark, FOLDER, day, database), "daily_follower_following")
    assert spark.table(name).where("owner_id IS NOT NULL").count() == known


def test_backfill_is_repeatable(spark, database, rows):
    ctx = context(spark, FOLDER, dt.date(2024, 2, 1), database)
    backfill(ctx, "slice_copy", dt.date(2024, 1, 1), dt.date(2024, 2, 1))
    once = rows(ctx.target("slice_copy"))
    backfill(ctx, "slice_copy", dt.date(2024, 1, 1), dt.date(2024, 2, 1), one_by_one=True)
    assert rows(ctx.target("slice_copy")) == once and len(once) > 0
    run_slice(ctx, "slice_copy", dt.date(2024, 1, 1), dt.date(2024, 2, 1))
    assert rows(ctx.target("slice_copy")) == once


def test_full_refresh_and_hooks(spark, database):
    calls = []
    ctx = context(spark, FOLDER, dt.date(2024, 3, 1), database)
    model = registry.MODELS["latest_transfer_permission"]
    hooked = registry.Model(
        "hooked", model.build, materialized="table", path="normal/hooked",
        pre=lambda c: calls.append("pre"), post=lambda c: calls.append(tables.exists(c.spark, c.table("hooked"))),
    )
    registry.MODELS["hooked"] = hooked
    try:
        assert run(ctx, "hooked") == ["hooked"]
    finally:
        del registry.MODELS["hooked"]
    assert calls == ["pre", True]
    run(ctx, "copied_table")
    assert ctx.is_incremental("copied_table")
    ctx.full_refresh = True
    assert not ctx.is_incremental("copied_table")


def test_view_models_are_not_stored(spark, database):
    ctx = context(spark, FOLDER, dt.date(2024, 3, 1), database)
    build = registry.MODELS["latest_transfer_permission"].build
    registry.MODELS["permission_view"] = registry.Model("permission_view", build, materialized="view", path="view/permission_view")
    try:
        run(ctx, "permission_view")
    finally:
        del registry.MODELS["permission_view"]
    assert spark.table("permission_view").count() == build(ctx).count()
    assert not tables.exists(spark, f"{database}.permission_view")


def test_limit_is_only_on_request(spark):
    def access(**params):
        return context(spark, FOLDER, dt.date(2001, 7, 30), access_days=3000, **params).ref("content_access").count()

    assert access() > 1 and access(limit=1) == 1


def test_dates_and_columns_reach_the_scan(spark):
    df = date_slice(table(spark, FOLDER, "orders"), "o_orderdate", "1998-01-01", "1998-02-01").select("o_orderkey")
    plan = plan_of(df)
    pushed = plan.split("PushedFilters:")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_early_purchases_are_an_anti_join(spark):
    events = table(spark, FOLDER, "events")
    firsts = events.where("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("f"))
    plan = plan_of(anti_before_first(events.where("event_type = 'purchase'"), firsts, "user_id", "user_id", "ts", "f"))
    assert "LeftAnti" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_bucketed_tables_join_without_a_shuffle(spark, database):
    for name in ("a", "b"):
        tables.write_bucketed(spark.range(100).select("id", F.col("id").alias(f"v_{name}")), f"{database}.{name}", "id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(spark.table(f"{database}.a").join(spark.table(f"{database}.b"), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan


def test_master_data_join_can_be_split(spark):
    """Both sides of the join on user and month come straight out of its own shuffle, so that a heavy user is split."""
    ctx = context(spark, FOLDER, dt.date(2001, 9, 30))
    ctx.keep("star_purchase", where="type = 'transfer_inbound'").keep("monthly_pay_user").keep("monthly_segmentation")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ctx.ref("pay_user_master_data")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin [user_id" in line and "coalesce" in line)
    depth = lines[join].index("SortMergeJoin")
    sides = [i for i, line in enumerate(lines) if line.find("Sort [") == depth + 3 and i > join]
    assert len(sides) >= 2 and all("Exchange hashpartitioning" in lines[i + 1] for i in sides[:2])


def test_a_kept_model_is_filtered_below_its_joins(spark):
    ctx = context(spark, FOLDER, dt.date(2001, 9, 30))
    everything = ctx.ref("star_purchase")
    lines = everything.where("type = 'transfer_inbound'")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    first_join = next(i for i, line in enumerate(lines) if "Join " in line)
    assert any("Filter" in line and "transfer_inbound" in line for line in lines[first_join:])
    kinds = {r.type for r in everything.select("type").distinct().collect()}
    ctx.keep("star_purchase", "type", where="type = 'transfer_inbound'")
    assert len(kinds) == 2 and {r.type for r in ctx.ref("star_purchase").distinct().collect()} == {"transfer_inbound"}


@pytest.mark.parametrize("name", ["star_purchase", "user_topup_transaction", "content_access", "latest_follow", "daily_transaction"])
def test_marts_have_no_nested_loops(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(context(spark, FOLDER, dt.date(2001, 7, 30)).ref(name))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_sources_can_be_replaced(spark):
    ctx = context(spark, FOLDER, dt.date(2024, 3, 1))
    ctx.sources = ChainMap({"allow_list": spark.createDataFrame([(1,), (None,)], "alias long")}, ctx.sources)
    assert [r.alias for r in ctx.ref("latest_transfer_permission").collect()] == [1]
