"""Stored tables: writing, replacing, merging, schema changes and expiry.

Tables live in the session catalog (``database.table``) as Parquet. Changes rewrite whole partitions with dynamic
partition overwrite, so only touched partitions are read and written, and readers see the old files until the commit.
A frame that was read from the table it goes to is staged in the shared folder first.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.incremental import Names, affected_slices, compact, edge_diff, scd2, upsert
from ledgerloom.operators.joins import as_list
from ledgerloom.operators.sets import anti, stack_frames
from ledgerloom.session import scratch_path, settings, stage
from ledgerloom.sources.readers import load_csv, require_slice

GRAINS = {"DAY": "yyyy-MM-dd", "MONTH": "yyyy-MM", "YEAR": "yyyy"}


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def grain_of(ts: Column, grain: str) -> Column:
    """Text of the day, month or year of a time: short folder names that sort like the time."""
    return F.date_format(ts, GRAINS[grain])


def _layout(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str]) -> DataFrame:
    """Rows of a partition together and sorted, so that files carry tight min/max statistics.

    ``rebalance`` lets the adaptive planner cut a large partition into several tasks instead of one.
    """
    if not sort_by and not partition_by:
        return df
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    return df.sortWithinPartitions(*partition_by, *sort_by)


def write(
    df: DataFrame, table: str, mode: str = "overwrite", partition_by: Names = (), sort_by: Names = ()
) -> None:
    """Replace a table (``overwrite``) or add to it (``append``), created on first use."""
    parts, order = as_list(partition_by), as_list(sort_by)
    spark = df.sparkSession
    if mode == "append" and exists(spark, table):
        _layout(df, parts, order).select(*spark.table(table).columns).write.insertInto(table)
        return
    writer = _layout(df, parts, order).write.mode(mode).format("parquet")
    (writer.partitionBy(*parts) if parts else writer).saveAsTable(table)


def write_bucketed(df: DataFrame, table: str, keys: Names, buckets: int) -> None:
    """Store a table bucketed and sorted by its join key, for joins without a shuffle."""
    names = as_list(keys)
    df.repartition(buckets, *names).write.mode("overwrite").bucketBy(buckets, *names).sortBy(*names).saveAsTable(table)


RANGES = 64  # ranges of a column that an interleaved layout tells apart


def range_id(col: Column, bounds: Sequence[object]) -> Column:
    """How many of the sorted bounds a value has reached, by halving; 0 for NULL."""
    if not bounds:
        return F.lit(0)
    middle = len(bounds) // 2
    reached = range_id(col, bounds[middle + 1 :]) + (middle + 1)
    return F.when(col >= F.lit(bounds[middle]), reached).otherwise(range_id(col, bounds[:middle]))


def interleaved(ids: Sequence[Column]) -> Column:
    """The bits of several range ids in turn, from the lowest ones up."""
    width = (RANGES - 1).bit_length()
    bits = [F.shiftleft(F.shiftright(n.cast("long"), b).bitwiseAND(1), b * len(ids) + i) for b in range(width) for i, n in enumerate(ids)]
    return reduce(lambda x, y: x.bitwiseOR(y), bits)


def write_interleaved(df: DataFrame, table: str, by: Sequence[str], files: int | None = None) -> None:
    """Store a table so that a filter on any of the columns ``by`` (numbers, dates, times) skips most files.

    Each column is cut into RANGES of about equally many rows, rows are dealt by the interleaved bits of their ranges,
    and every file so has narrow bounds of all of them. Up to ten columns; the bounds are one row of RANGES values each.
    """
    if not 0 < len(by) <= 10:
        raise ValueError("an interleaved layout is by one to ten columns")
    steps = [i / RANGES for i in range(1, RANGES)]
    found = df.agg(*[F.percentile_approx(c, steps, 20 * RANGES).alias(f"b{i}") for i, c in enumerate(by)]).first()
    ids = [range_id(F.col(c), sorted(set(found[i] or ()))) for i, c in enumerate(by)]
    placed = df.withColumn("_z", interleaved(ids))
    placed = placed.repartitionByRange(files, "_z") if files else placed.repartitionByRange("_z")
    placed.sortWithinPartitions("_z", *by).drop("_z").write.mode("overwrite").format("parquet").saveAsTable(table)


def write_partitioned(
    df: DataFrame, table: str, ts: str, grain: str = "DAY", mode: str = "overwrite", sort_by: Names = ()
) -> None:
    """Table partitioned by the day, month or year of a time column, kept in an extra column ``part_<ts>``."""
    part = f"part_{ts}"
    write(df.withColumn(part, grain_of(F.col(ts), grain)), table, mode, part, sort_by)
    set_property(df.sparkSession, table, "partition.time", ts)
    set_property(df.sparkSession, table, "partition.grain", grain)


def read_slice(
    spark: SparkSession, table: str, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Rows of a time-partitioned table with start <= time < end, reading only the partitions of that range.

    Bounds may be left out unless the table requires them.
    """
    known = properties(spark, table)
    df = spark.table(table)
    if start is None and end is None and known.get("partition.filter.required") != "true":
        return df
    ts, grain = known["partition.time"], known["partition.grain"]
    part = F.col(f"part_{ts}")
    first, last = (grain_of(F.lit(d).cast("date"), grain) for d in (start, end))
    return require_slice(df, ts, start, end).where((part >= first) & (part <= last))


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def overwrite_partitions(df: DataFrame, table: str, sort_by: Names = ()) -> None:
    """Replace exactly the partitions that occur in the frame."""
    spark = df.sparkSession
    ordered = df.select(*spark.table(table).columns)
    laid = _layout(ordered, partition_columns(spark, table), as_list(sort_by))
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        laid.write.mode("overwrite").insertInto(table)


SWAP = "swap.pending"  # table property: a change that was begun, as the path of its rows and the partitions it empties


def _swap_rows(result: DataFrame, table: str, emptied: Sequence[object] = ()) -> None:
    """Store the new rows of a table or of its touched partitions, then drop partitions that ran empty.

    Where both steps are needed, the rows are staged and the change is noted in a table property first and struck out
    last: :func:`finish_swap`, which every change calls before it reads the table, repeats a change that was cut off.
    """
    spark = result.sparkSession
    parts = partition_columns(spark, table)
    if not parts:
        stage(result).write.mode("overwrite").insertInto(table)
        return
    if not emptied:
        overwrite_partitions(result, table)
        return
    path = scratch_path(spark, "swap")
    result.write.parquet(path)
    noted = json.dumps({"path": path, "part": parts[0], "emptied": [None if v is None else str(v) for v in emptied]})
    set_property(spark, table, SWAP, noted)
    finish_swap(spark, table)


def finish_swap(spark: SparkSession, table: str) -> bool:
    """Carry out a change that was noted and not struck out; whether there was one. Done twice it changes nothing more."""
    noted = properties(spark, table).get(SWAP)
    if not noted:
        return False
    change = json.loads(noted)
    overwrite_partitions(spark.read.schema(spark.table(table).schema).parquet(change["path"]), table)
    drop_partitions(spark, table, change["part"], change["emptied"])
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{SWAP}')")
    return True


def _swap_touched(result: DataFrame, table: str, part: str, touched: Sequence[object]) -> None:
    """Store the rows that the touched partitions have now, and drop those of them that the result leaves empty.

    Only the result tells: a new row that loses by its version does not keep its partition alive.
    """
    result = stage(result)
    left = {r[0] for r in result.select(part).distinct().collect()}
    _swap_rows(result, table, [v for v in touched if v not in left])


def drop_partitions(spark: SparkSession, table: str, part: str, values: Sequence[object]) -> None:
    """Drop partitions by value, many per statement."""
    specs = [f"PARTITION (`{part}` = {'null' if v is None else repr(str(v))})" for v in values]
    for first in range(0, len(specs), 1000):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs[first : first + 1000])}")


def _within(part: str, values: Sequence[object]) -> Column:
    known = [v for v in values if v is not None]
    inside = F.col(part).isin(known) if known else F.lit(False)
    return inside | F.col(part).isNull() if len(known) < len(values) else inside


def replace_by_values(df: DataFrame, table: str, col: str) -> None:
    """Delete the rows whose ``col`` has one of the values that occur in the frame, then add the frame.

    Where ``col`` is the partition column this is an overwrite of those partitions. Otherwise the partitions that hold
    such rows are rewritten. A NULL in the frame replaces nothing, as in SQL ``IN``.
    """
    spark = df.sparkSession
    parts = partition_columns(spark, table)
    fresh = stage(df)
    finish_swap(spark, table)
    if parts == [col] and fresh.where(F.col(col).isNull()).isEmpty():
        overwrite_partitions(fresh, table)
        return
    old = spark.table(table)
    values = fresh.select(col)
    if not parts:
        _swap_rows(anti(old, values, col).unionByName(fresh), table)
        return
    part = parts[0]
    touched = affected_slices(old, fresh, col, part, unique=False)
    kept = anti(old.where(_within(part, touched)), values, col)
    _swap_touched(kept.unionByName(fresh), table, part, touched)


def replace_slice(df: DataFrame, table: str, ts: str, grain: str, start: dt.date, end: dt.date) -> None:
    """Replace the rows with start <= ts < end of a table written by :func:`write_partitioned`.

    Only partitions of that range are touched; rows outside the range stay, also where the range cuts a partition.
    """
    spark, part = df.sparkSession, f"part_{ts}"
    fresh = stage(df.withColumn(part, grain_of(F.col(ts), grain)))
    finish_swap(spark, table)
    first, last = (grain_of(F.lit(d).cast("date"), grain) for d in (start, end))
    old = spark.table(table).where((F.col(part) >= first) & (F.col(part) <= last))
    inside = (F.col(ts) >= F.lit(start).cast("date")) & (F.col(ts) < F.lit(end).cast("date"))
    result = old.where(~inside).unionByName(fresh.select(*old.columns))
    remaining = {r[0] for r in result.select(part).distinct().collect()}
    stored = [r[0] for r in old.select(part).distinct().collect()]
    _swap_rows(result, table, [v for v in stored if v not in remaining])


def merge(
    df: DataFrame, table: str, keys: Names, version: str | None = None, fixed_partition: bool = False, tie: Names = ()
) -> None:
    """Upsert into a stored table; see :func:`ledgerloom.operators.incremental.upsert`.

    Only partitions that hold a key of the new rows, or receive one, are rewritten; a table without partitions is rewritten
    whole. ``fixed_partition`` promises that a key never changes its partition, which saves the search for old rows
    elsewhere. A merge that is cut off is finished by the next change of the table.
    """
    spark = df.sparkSession
    fresh = stage(df)
    finish_swap(spark, table)
    old = spark.table(table)
    parts = partition_columns(spark, table)
    if not parts:
        _swap_rows(upsert(old, fresh, keys, version, tie), table)
        return
    part = parts[0]
    if fixed_partition:
        touched = [r[0] for r in fresh.select(part).distinct().collect()]
        _swap_rows(upsert(old.where(_within(part, touched)), fresh, keys, version, tie), table)
        return
    touched = affected_slices(old, fresh, keys, part)
    result = upsert(old.where(_within(part, touched)), fresh, keys, version, tie)
    _swap_touched(result, table, part, touched)


HISTORY, OPEN = "part_valid", "open"  # partition column of a history: OPEN, or the day on which its rows were closed


def record_history(df: DataFrame, table: str, keys: Names, as_of: dt.date, close_missing: bool = False) -> None:
    """Apply a snapshot to a stored history; see :func:`ledgerloom.operators.incremental.scd2`. Created on first use.

    Open rows are a partition of their own, which alone is read and rewritten; rows that the snapshot closes move to the
    partition of its day. Older days are neither read nor written, so a run costs what is open. Both partitions change in one
    write, and the same snapshot applied again changes nothing.
    """
    spark = df.sparkSession
    columns = [*df.columns, "valid_from", "valid_to", HISTORY]
    if not exists(spark, table):
        dated = df.withColumns({"valid_from": F.lit(as_of).cast("date"), "valid_to": F.lit(None).cast("date"), HISTORY: F.lit(OPEN)})
        write(dated.select(*columns), table, partition_by=HISTORY)
        return
    fresh = stage(df)
    finish_swap(spark, table)
    old = spark.table(table)
    result = scd2(old.where(F.col(HISTORY) == OPEN).drop(HISTORY), fresh, keys, as_of, close_missing)
    result = result.withColumn(HISTORY, F.coalesce(F.date_format("valid_to", "yyyy-MM-dd"), F.lit(OPEN)))
    # a second snapshot of the day adds to what the first one closed
    both = result.unionByName(old.where(F.col(HISTORY) == as_of.isoformat()))
    _swap_touched(both, table, HISTORY, [OPEN])


def read_history(spark: SparkSession, table: str, on: dt.date | None = None) -> DataFrame:
    """A stored history: the rows valid on a day, from the open ones and those closed later, or all of them."""
    df = spark.table(table)
    if on is not None:
        df = df.where((F.col(HISTORY) == OPEN) | (F.col(HISTORY) > on.isoformat()))
        df = df.where((F.col("valid_from") <= F.lit(on)) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(on))))
    return df.drop(HISTORY)


LIVE, RUN = "edges.live", "part_run"  # table property: the day of the last run and its live edges; partition column: the day of the run


def live_changes(live: DataFrame, latest: DataFrame, as_of: dt.datetime, ends: tuple[str, str], window_days: int = 3) -> DataFrame:
    """What a snapshot changes in the live edges; see :func:`ledgerloom.operators.incremental.edge_diff`.

    The live edges are stored bucketed by the join's key, so that only the snapshot is shuffled.
    """
    return edge_diff(live, latest.select(*live.columns), as_of, *ends, window_days)


def live_edges(spark: SparkSession, table: str) -> tuple[str, str]:
    """The day of a history's last run, and the table of its live edges."""
    day, live = json.loads(table_property(spark, table, LIVE))
    return day, live


def record_edges(
    latest: DataFrame, table: str, as_of: dt.datetime, ends: tuple[str, str] = ("owner_id", "follower_id"), since: dt.date | None = None, window_days: int = 3, buckets: int | None = None
) -> None:
    """Apply a snapshot of an edge set to a stored history of its changes. Created on first use.

    The history has a partition per run, and no run reads those before it. What a snapshot can change lies apart: edges
    that are open, or dated from ``since`` on (where the snapshot begins; by default all). These are a table of their own,
    bucketed by both ends and the date. Each run writes a new one, which the history's property then names: a run that
    is cut off leaves the old one in force, and its repetition writes the same changes to the same partition. Another run of a
    day that has ended adds to the day's partition.
    """
    spark, keys = latest.sparkSession, [*ends, "date_key"]
    day = F.lit(as_of.date().isoformat())
    fresh = stage(latest)
    known = exists(spark, table)
    if known:
        last, before = live_edges(spark, table)
        live = spark.table(before)
        changes = stage(live_changes(live, fresh, as_of, ends, window_days).select(*fresh.columns))
        run = changes.withColumn(RUN, day)
        if last == as_of.date().isoformat():
            run = stage(run.unionByName(spark.table(table).where(F.col(RUN) == last)).distinct())
        overwrite_partitions(run, table)
        live = live.join(changes.select(*keys), keys, "left_anti").select(*fresh.columns).unionByName(changes)
    else:
        write(fresh.withColumn(RUN, day), table, partition_by=RUN)
        live = fresh
    if since is not None:
        live = live.where(F.coalesce("following_status", F.lit(False)) | (F.col("date_key") >= F.lit(since)))
    now = f"{table}_live_{uuid.uuid4().hex[:12]}"
    write_bucketed(live, now, keys, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    set_property(spark, table, LIVE, json.dumps([as_of.date().isoformat(), now]))
    if known:
        drop(spark, before)


MARK = "compacted.upto"  # table property: when the newest file was written that a compaction has seen


def _written(spark: SparkSession, table: str, parts: Sequence[str]) -> DataFrame:
    """Partition values and the time of the newest file in each; no column of the rows is read."""
    files = spark.table(table).select(*parts, F.col("_metadata.file_modification_time").alias("_at"))
    return files.groupBy(*parts).agg(F.max("_at").alias("_at"))


def compact_table(
    spark: SparkSession, table: str, keys: Names, version: str | None = None, tie: Names = ()
) -> None:
    """Leave one row per key in the stored table.

    Only partitions with a file from after the last compaction, and others that hold one of their keys, are looked at, and
    only those that lose rows are rewritten. A table without partitions is rewritten whole. The time of the newest
    file seen is kept as a table property; files of the very same time count as new the next time. Keys are those of
    the call before: after a change of keys, unset the property.
    """
    finish_swap(spark, table)
    parts = partition_columns(spark, table)
    if not parts:
        _swap_rows(compact(spark.table(table), keys, version, tie), table)
        return
    part = parts[0]
    spark.catalog.refreshTable(table)
    mark = properties(spark, table).get(MARK)
    written = stage(_written(spark, table, parts[:1]), "written")
    fresh = written if mark is None else written.where(F.col("_at") >= F.timestamp_micros(F.lit(int(mark))))
    changed = [r[0] for r in fresh.select(part).collect()]
    if changed:
        old = spark.table(table)
        new = old.where(_within(part, changed))
        touched = changed if mark is None else affected_slices(old, new, keys, part, unique=False)
        before = old.where(_within(part, touched))
        result = stage(compact(before, keys, version, tie))
        counts = before.groupBy(part).agg(F.count(F.lit(1)).alias("n")).unionByName(result.groupBy(part).agg((-F.count(F.lit(1))).alias("n")))
        kept = {r[0] for r in result.select(part).distinct().collect()}
        losing = [r[0] for r in counts.groupBy(part).agg(F.sum("n").alias("n")).where("n > 0").collect()]
        if losing:
            _swap_rows(result.where(_within(part, losing)), table, [v for v in losing if v not in kept])
            spark.catalog.refreshTable(table)
    newest = _written(spark, table, parts[:1]).agg(F.unix_micros(F.max("_at")).alias("at")).first()["at"]
    if newest is not None:
        set_property(spark, table, MARK, str(newest))


def update_table(
    df: DataFrame,
    table: str,
    mode: str = "truncate",
    partition_col: str | None = None,
    grain: str | None = None,
    expiry_days: int | None = None,
    partition_expiry_days: int | None = None,
    partition_filter: bool = False,
    as_of: dt.date | None = None,
) -> None:
    """Load a frame: ``truncate`` replaces the table, ``append`` adds, ``truncate_partition`` replaces the values of
    the partition column that occur in the frame. Expiry settings are kept as table properties;
    ``expiry_days`` counts from ``as_of``."""
    spark = df.sparkSession
    if expiry_days and as_of is None:
        raise ValueError("expiry_days needs as_of, the day from which it counts")
    if mode not in ("truncate", "append", "truncate_partition"):
        raise ValueError(f"unknown mode {mode!r}")
    timed = partition_col is not None and grain is not None
    disposition = "append" if mode == "append" else "overwrite"
    if not timed:
        if mode == "truncate_partition":
            raise ValueError("truncate_partition needs a partition column and its grain")
        write(df, table, disposition)
    elif mode == "truncate_partition" and exists(spark, table):
        part = f"part_{partition_col}"
        replace_by_values(df.withColumn(part, grain_of(F.col(partition_col), grain)), table, partition_col)
    else:
        write_partitioned(df, table, partition_col, grain, disposition)
    if expiry_days:
        set_table_expiry(spark, table, expiry_days, as_of)
    if partition_expiry_days and timed:
        set_property(spark, table, "partition.expiry.days", partition_expiry_days)
        if partition_filter:
            set_property(spark, table, "partition.filter.required", "true")


def conform_for_ingest(df: DataFrame, fill_epoch: bool = True) -> DataFrame:
    """Whole numbers to long, fractions to double, dates to datetimes, everything else but booleans to text.

    A missing datetime becomes 1970-01-01 unless that is switched off.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

    def conformed(field: T.StructField) -> Column:
        c, t = F.col(f"`{field.name}`"), field.dataType
        if isinstance(t, T.IntegralType):
            out = c.cast("long")
        elif isinstance(t, (T.FractionalType,)):
            out = c.cast("double")
        elif isinstance(t, T.BooleanType):
            out = c
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out = c.cast("timestamp_ntz")
            out = F.coalesce(out, epoch) if fill_epoch else out
        elif isinstance(t, (T.ArrayType, T.MapType, T.StructType)):
            out = F.to_json(c)
        else:
            out = c.cast("string")
        return out.alias(field.name)

    return df.select(*[conformed(f) for f in df.schema.fields])


def ingest(
    df: DataFrame, table: str, mode: str = "append", partition_by: str | None = None, grain: str = "MONTH"
) -> None:
    """Conform the types and load: ``truncate`` recreates the table, ``append`` creates it if missing."""
    if mode not in ("truncate", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    rows = conform_for_ingest(df)
    disposition = "overwrite" if mode == "truncate" else "append"
    if partition_by:
        write_partitioned(rows, table, partition_by, grain, disposition)
    else:
        write(rows, table, disposition)


def append_with_ingest_date(df: DataFrame, table: str, as_of: dt.date) -> None:
    """Append to a table partitioned by the day of loading."""
    write(df.withColumn("_ingest_date", F.lit(as_of).cast("date")), table, "append", "_ingest_date")


def export(df: DataFrame, folder: str, name: str, fmt: str = "csv") -> str:
    """Write a frame as csv, parquet or json files below ``folder``; returns the path with its ending."""
    kind = fmt.lower()
    if kind not in ("csv", "parquet", "json"):
        raise ValueError(f"unsupported format {fmt!r}")
    path = f"{folder.rstrip('/')}/{name if name.endswith(f'.{fmt}') else f'{name}.{fmt}'}"
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer = writer.option("header", True)
    writer.format(kind).save(path)
    return path


def load_parquet(spark: SparkSession, path: str, table: str, mode: str = "truncate") -> None:
    """Load Parquet files with their own schema into a table."""
    if mode not in ("truncate", "append", "empty"):
        raise ValueError(f"unknown mode {mode!r}")
    disposition = {"truncate": "overwrite", "append": "append", "empty": "errorifexists"}[mode]
    write(spark.read.parquet(path), table, disposition)


def seed(spark: SparkSession, path: str, table: str, schema: T.StructType | None = None) -> None:
    """Table filled from a CSV file kept with the code."""
    write(load_csv(spark, path, schema), table, "overwrite")


def stack_tables(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """Several stored tables read as one."""
    return stack_frames(*[spark.table(t) for t in tables])


def ctas(spark: SparkSession, table: str, query: str | DataFrame) -> None:
    """Create or replace a table from a query."""
    write(spark.sql(query) if isinstance(query, str) else query, table, "overwrite")


def table_schema(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    return spark.table(table).dtypes


def add_columns(spark: SparkSession, table: str, **types: str) -> None:
    """Add columns; rows written before have NULL in them."""
    columns = ", ".join(f"`{name}` {kind}" for name, kind in types.items())
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def truncate(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


def set_property(spark: SparkSession, table: str, name: str, value: object) -> None:
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{name}' = '{text}')")


def table_property(spark: SparkSession, table: str, name: str) -> str | None:
    return properties(spark, table).get(name)


def set_table_expiry(spark: SparkSession, table: str, days: int, as_of: dt.date) -> None:
    """The whole table expires ``days`` days after ``as_of``; :func:`expire_table` acts on it."""
    set_property(spark, table, "expires.on", (as_of + dt.timedelta(days=days)).isoformat())


def expire_table(spark: SparkSession, table: str, as_of: dt.date) -> bool:
    """Drop the table if its expiry date has come."""
    due = table_property(spark, table, "expires.on")
    if due is None or dt.date.fromisoformat(due) > as_of:
        return False
    drop(spark, table)
    return True


def expire_partitions(spark: SparkSession, table: str, days: int, as_of: dt.date) -> int:
    """Drop the partitions whose period began more than ``days`` days before ``as_of``; no rows are read."""
    part = partition_columns(spark, table)[0]
    bound = as_of - dt.timedelta(days=days)
    listed = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    old = [v for v in listed if re.fullmatch(r"\d{4}(-\d{2}){0,2}", v) and _period_start(v) < bound]
    drop_partitions(spark, table, part, old)
    return len(old)


def _period_start(value: str) -> dt.date:
    year, month, day = (*map(int, value.split("-")), 1, 1)[:3]
    return dt.date(year, month, day)
