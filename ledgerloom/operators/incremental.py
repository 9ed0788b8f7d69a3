"""Keeping a target up to date: merges by key, snapshot differences and the documented table kinds.

All functions are frame in, frame out; ``sources.tables`` stores the results partition by partition.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.cases import case_when, state_changed
from ledgerloom.functions.dates import back
from ledgerloom.operators.joins import as_list
from ledgerloom.operators.numbering import number_rows
from ledgerloom.operators.sets import semi
from ledgerloom.operators.windows import latest_per_key
from ledgerloom.session import stage

Names = str | Sequence[str]
RANKS = {True: "ranks_whole", False: "ranks"}  # columns of quantile sketches of whole numbers, and of others


def read_final(df: DataFrame, keys: Names, version: str | None = None, tie: Names = ()) -> DataFrame:
    """A replacing table read as if merged: the highest version of each key.

    Without a version the row that comes first by ``tie``, then by a hash of its values, stands for its key.
    """
    if version is not None:
        return latest_per_key(df, keys, version, tie)
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return latest_per_key(df.withColumn("_any", F.xxhash64(*hashable)), keys, (), [*as_list(tie), "_any"]).drop("_any")


def compact(target: DataFrame, keys: Names, version: str | None = None, tie: Names = ()) -> DataFrame:
    """One row per key; compacting again changes nothing."""
    return read_final(target, keys, version, tie)


def upsert(target: DataFrame, new: DataFrame, keys: Names, version: str | None = None, tie: Names = ()) -> DataFrame:
    """Merge new rows by key.

    With a version column the highest version of a key wins, the new row on equal versions. Without one the new row
    always wins, and ``new`` must hold a key once.
    """
    if version is None:
        return target.join(new.select(*as_list(keys)), as_list(keys), "left_anti").unionByName(new)
    both = target.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return latest_per_key(both, keys, [version, "_new"], tie).drop("_new")


def edge_diff(
    target: DataFrame,
    latest: DataFrame,
    as_of: dt.datetime,
    source: str = "owner_id",
    sink: str = "follower_id",
    window_days: int = 3,
) -> DataFrame:
    """Changes of an edge set since the stored history: new edges as ``follow``, vanished edges as ``unfollow``.

    An edge is keyed by both ends and its date, so a second follow on a later date is a new row. Emits only changes
    dated within the window and keeps the newest change per edge. On an unchanged snapshot nothing is emitted.
    """
    keys = [source, sink, "date_key"]
    t = target.select([F.col(c).alias(f"t_{c}") for c in target.columns])
    on = [F.col(k) == F.col(f"t_{k}") for k in keys]
    gone = F.col(source).isNull()  # also true for an edge of the snapshot whose source is unknown
    now = F.lit(as_of.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    never = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

    def either(c: str) -> Column:
        return F.coalesce(F.col(c), F.col(f"t_{c}")).alias(c)

    joined = t.join(latest, on, "full").where(state_changed(F.col("following_status"), F.col("t_following_status")))
    rows = joined.select(
        either("date_key"),
        either(source),
        either(sink),
        either("followed_at"),
        F.when(gone, now).otherwise(never).alias("unfollowed_at"),
        (~gone).alias("following_status"),
        either("is_auto_follow"),
        F.when(gone, "unfollow").otherwise("follow").alias("note"),
    )
    since = back(as_of.date(), window_days, "days")
    recent_rows = rows.where((F.col("date_key") >= since) | (F.to_date("unfollowed_at") >= since))
    return latest_per_key(recent_rows, [source, sink], "date_key", "followed_at")


def dim_diff(
    target: DataFrame,
    latest: DataFrame,
    as_of: dt.date,
    key: str = "user_id",
    window_days: int = 3,
    strict: bool = False,
) -> DataFrame:
    """Changes of a permission dimension: new keys are inserted, vanished keys lose the permission.

    By default a key on both sides is left as it is, even if it had lost the permission, and a loss is reported only
    for rows created or updated within the window. ``strict`` grants a returning key again, reports every loss, and
    dates both with ``as_of``.
    """
    t = target.select([F.col(c).alias(f"t_{c}") for c in target.columns])
    joined = t.join(latest, F.col(key) == F.col(f"t_{key}"), "full")
    in_target, in_latest = F.col(f"t_{key}").isNotNull(), F.col(key).isNotNull()
    today = F.lit(as_of).cast("date")

    allowed = case_when(
        [
            (in_target & in_latest, F.coalesce("t_is_allowed", "is_allowed")),
            (~in_latest, F.lit(False)),
        ],
        F.coalesce("is_allowed", F.lit(False)),
    )
    operation = case_when([(in_target & in_latest, F.lit("as_is")), (~in_target, F.lit("insert"))], F.lit("update"))
    updated = F.coalesce("last_updated_at", "t_last_updated_at")
    if strict:
        returning = in_target & in_latest & ~F.col("t_is_allowed") & F.col("is_allowed")
        lost = ~in_latest & F.col("t_is_allowed")
        allowed = F.when(returning, True).otherwise(allowed)
        operation = case_when(
            [(returning, F.lit("update")), (~in_latest & ~lost, F.lit("as_is"))], operation
        )
        updated = F.when(returning | lost, today).otherwise(updated)

    rows = joined.select(
        F.coalesce(key, f"t_{key}").alias(key),
        F.coalesce("t_alias", "alias").alias("alias"),
        allowed.alias("is_allowed"),
        F.coalesce("t_created_at", "created_at").alias("created_at"),
        updated.alias("last_updated_at"),
        operation.alias("_operation"),
    )
    since = back(as_of, window_days, "days")
    changed = rows.where((F.col("created_at") >= since) | (F.col("last_updated_at") >= since))
    return latest_per_key(changed.where("_operation != 'as_is'").drop("_operation"), key, "created_at", "alias")


def scd2(
    target: DataFrame, new: DataFrame, keys: Names, as_of: dt.date, close_missing: bool = False
) -> DataFrame:
    """Slowly changing history with ``valid_from`` and ``valid_to`` (NULL = current).

    A changed key gets its current row closed at ``as_of`` and a new one opened; unchanged rows stay. Keys missing
    from ``new`` are closed only on request. Applying the same snapshot again changes nothing.
    """
    names = as_list(keys)
    values = [c for c in new.columns if c not in names]
    today = F.lit(as_of).cast("date")
    closed = target.where(F.col("valid_to").isNotNull())
    current = target.where(F.col("valid_to").isNull()).withColumn("_stored", F.lit(True))
    fresh = new.select(*names, F.struct(*values).alias("_fresh"))
    joined = current.join(fresh, names, "full")

    stored_values = F.struct(*values)
    changed = F.col("_stored") & F.col("_fresh").isNotNull() & ~stored_values.eqNullSafe(F.col("_fresh"))
    missing = F.col("_stored") & F.col("_fresh").isNull() & F.lit(close_missing)
    ends = F.when(changed | missing, today)
    stored_row = F.struct(*[F.col(c) for c in values], F.col("valid_from"), ends.alias("valid_to"))
    new_row = F.struct(
        *[F.col(f"_fresh.{c}") for c in values], today.alias("valid_from"), F.lit(None).cast("date").alias("valid_to")
    )
    rows = F.array_compact(
        F.array(
            F.when(F.col("_stored"), stored_row),
            F.when(F.col("_stored").isNull() | changed, new_row),
        )
    )
    updated = joined.select(*names, F.inline(rows))
    return closed.unionByName(updated.select(*closed.columns))


def summing(frames: Sequence[DataFrame], keys: Names, measures: Sequence[str]) -> DataFrame:
    """Old and new rows added up per key."""
    stacked = frames[0]
    for df in frames[1:]:
        stacked = stacked.unionByName(df)
    return stacked.groupBy(*as_list(keys)).agg(*[F.sum(m).alias(m) for m in measures])


def agg_state(df: DataFrame, keys: Names, measure: str, distinct: str | None = None, quantiles: bool = False) -> DataFrame:
    """Stored partial aggregates per key: count, sum, min, max and, on request, sketches.

    ``distinct`` is the column of a distinct-count sketch; ``quantiles`` adds a quantile sketch of the measure, of a few
    kilobytes, whose ranks are off by about 1.3 percent (whole numbers and others are kept apart).
    """
    value = F.col(measure)
    aggs = [F.count(value), F.sum(value), F.min(value), F.max(value)]
    named = [a.alias(n) for a, n in zip(aggs, ("n", "total", "low", "high"))]
    if distinct:
        named.append(F.hll_sketch_agg(distinct).alias("sketch"))
    if quantiles:
        whole = isinstance(df.schema[measure].dataType, T.IntegralType)
        named.append((F.kll_sketch_agg_bigint(value.cast("bigint")) if whole else F.kll_sketch_agg_double(value.cast("double"))).alias(RANKS[whole]))
    return df.groupBy(*as_list(keys)).agg(*named)


def merge_states(states: DataFrame, keys: Names) -> DataFrame:
    """Partial aggregates of several runs or finer keys merged to one state per key."""
    merged = [F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")]
    if "sketch" in states.columns:
        merged.append(F.hll_union_agg("sketch").alias("sketch"))
    if RANKS[True] in states.columns:
        merged.append(F.kll_merge_agg_bigint(RANKS[True]).alias(RANKS[True]))
    if RANKS[False] in states.columns:
        merged.append(F.kll_merge_agg_double(RANKS[False]).alias(RANKS[False]))
    return states.groupBy(*as_list(keys)).agg(*merged)


def finish_states(states: DataFrame, shares: Sequence[float] = (0.5,)) -> DataFrame:
    """Readable results of stored states; with quantile sketches the quantiles ``q50`` and so on of the shares."""
    out = states.withColumn("mean", F.col("total") / F.nullif(F.col("n"), F.lit(0)))
    if "sketch" in states.columns:
        out = out.withColumn("distinct_estimate", F.hll_sketch_estimate("sketch")).drop("sketch")
    read = {RANKS[True]: F.kll_sketch_get_quantile_bigint, RANKS[False]: F.kll_sketch_get_quantile_double}
    for column in set(read) & set(states.columns):
        at = {f"q{share * 100:g}": read[column](column, F.lit(float(share))) for share in shares}
        out = out.withColumns({n: F.when(F.col("n") > 0, q) for n, q in at.items()}).drop(column)
    return out


def collapse(df: DataFrame, keys: Names, sign: str, order: Names, tie: Names = ()) -> DataFrame:
    """Rows written as +1 and taken back as -1: the latest +1 row of every key whose signs add up above zero."""
    names = as_list(keys)
    net = df.groupBy(*names).agg(F.sum(sign).alias("_net")).where("_net > 0").drop("_net")
    rows = latest_per_key(df.where(F.col(sign) == 1), names, order, tie)
    return rows.join(net, names, "left_semi")


def collapse_versions(df: DataFrame, keys: Names, sign: str, version: str, tie: Names = ()) -> DataFrame:
    """Collapsing within each version of a key, in any order of arrival: versions that were taken back vanish."""
    names = [*as_list(keys), version]
    net = df.groupBy(*names).agg(F.sum(sign).alias("_net")).where("_net > 0").drop("_net")
    rows = latest_per_key(df.where(F.col(sign) == 1), names, version, tie)
    return rows.join(net, names, "left_semi")


def rollup_by_age(
    df: DataFrame,
    keys: Names,
    ts: str,
    measure: str,
    rules: Sequence[tuple[int, str]],
    as_of: dt.date,
) -> DataFrame:
    """A metric series kept coarser with age.

    ``rules`` are (age in days, grain) with rising ages: rows at least that old use that grain. The first rule must
    start at age 0.
    """
    age = F.date_diff(F.lit(as_of).cast("date"), F.to_date(ts))
    steps = sorted(rules, reverse=True)
    at = case_when([(age >= days, F.date_trunc(grain, F.col(ts))) for days, grain in steps], F.date_trunc(rules[0][1], F.col(ts)))
    grain = case_when([(age >= days, F.lit(g)) for days, g in steps], F.lit(rules[0][1]))
    grouped = df.groupBy(*as_list(keys), grain.alias("grain"), at.cast("timestamp_ntz").alias("bucket_at"))
    value = F.col(measure)
    return grouped.agg(
        F.count(value).alias("n"), F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high")
    )


def process_remaining(
    inputs: DataFrame,
    log: DataFrame | None,
    work: Callable[[DataFrame], DataFrame],
    key: str,
    as_of: dt.datetime,
    order: Sequence[str | Column] = (),
) -> DataFrame:
    """Log rows for the inputs that are not in the log yet.

    ``work`` turns the remaining inputs into a frame with the key and the result columns; inputs it drops are not
    logged and come back next time. New rows continue the log's numbering.
    """
    remaining = inputs
    if log is not None:
        remaining = inputs.join(log.select(F.col("key_column").alias(key)), key, "left_anti")
    # Stored before it is numbered, so that the work on each input is done once.
    done = stage(work(remaining), "processed")
    results = [c for c in done.columns if c != key]
    last = 0 if log is None else log.agg(F.max("row_number")).first()[0] or 0
    numbered = number_rows(done, order or [key, *_sortable(done, results)], start=last + 1)
    written = F.lit(as_of.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    return numbered.select("row_number", F.col(key).alias("key_column"), written.alias("write_time"), *results)


def _sortable(df: DataFrame, names: Sequence[str]) -> list[str]:
    types: Mapping[str, str] = dict(df.dtypes)
    return [n for n in names if not types[n].startswith(("map", "variant", "array", "struct"))]


def affected_slices(target: DataFrame, new: DataFrame, keys: Names, part: str, unique: bool = True) -> list:
    """Values of the partition column that a change touches: where new rows go, and where their keys lie now.

    The list has at most one entry per stored partition. ``unique`` tells that a key has one row in the target, so no
    key needs to be spread.
    """
    names = as_list(keys)
    stored = target.select(*dict.fromkeys([*names, part]))
    if unique:
        holding = stored.join(new.select(*names).distinct(), names, "left_semi")
    else:
        holding = semi(stored, new, names)
    return [row[0] for row in new.select(part).union(holding.select(part)).distinct().collect()]
