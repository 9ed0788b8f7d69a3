"""Models: functions from a context to a DataFrame, with how their result is kept."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.functions.dates import month_windows
from ledgerloom.operators.filters import date_slice
from ledgerloom.operators.incremental import compact
from ledgerloom.session import stage
from ledgerloom.sources import tables


@dataclass(frozen=True)
class Model:
    name: str
    build: Callable[[Context], DataFrame]
    after: tuple[str, ...] = ()
    tags: tuple[str, ...] = ()
    path: str = ""
    materialized: str = "table"
    partition_by: tuple[str, str] | None = None
    sort_by: tuple[str, ...] = ()
    unique_key: tuple[str, ...] = ()
    version: str | None = None
    fixed_partition: bool = False
    tie: tuple[str, ...] = ()
    pre: Callable[[Context], None] | None = None
    post: Callable[[Context], None] | None = None


MODELS: dict[str, Model] = {}

# Defaults per folder of models: how results are kept and which tag they run under.
FOLDERS: dict[str, dict[str, object]] = {
    "ledger": {"materialized": "table", "tags": ("ledger",)},
    "ledger_inline": {"materialized": "ephemeral", "tags": ("ledger_inline",)},
    "merged": {"materialized": "incremental", "tags": ("merged",)},
    "normal": {"materialized": "table", "tags": ("normal",)},
    "sliced": {"materialized": "incremental", "tags": ("sliced",)},
    "view": {"materialized": "view", "tags": ("view",)},
    "inline": {"materialized": "ephemeral", "tags": ("inline",)},
}


def model(name: str, path: str, after: Sequence[str] = (), **settings) -> Callable:
    """Register a builder. Settings override the defaults of its folder (the first part of ``path``)."""

    def register(build: Callable[[Context], DataFrame]) -> Callable[[Context], DataFrame]:
        defaults = FOLDERS.get(path.split("/")[0], {})
        MODELS[name] = Model(name, build, tuple(after), path=path, **{**defaults, **settings})
        return build

    return register


@dataclass
class Context:
    """What a model may read: named sources, other models, its own stored table, the day it runs for, parameters."""

    spark: SparkSession
    sources: Mapping[str, DataFrame]
    as_of: dt.date
    params: Mapping[str, object] = field(default_factory=dict)
    database: str | None = None
    full_refresh: bool = False
    _built: dict[str, DataFrame] = field(default_factory=dict)

    def source(self, name: str) -> DataFrame:
        return self.sources[name]

    def ref(self, name: str) -> DataFrame:
        """Result of another model: its stored table if this run has stored it, else its query."""
        if name not in self._built:
            self._built[name] = MODELS[name].build(self)
        return self._built[name]

    def keep(self, name: str, *columns: str, where: str = "true") -> Context:
        """Store a model that several others read, once for this run; only the named columns if any are given.

        Only rows that meet ``where`` are stored: a filter set here reaches the scans below the stored copy.
        """
        result = self.ref(name).where(where)
        self._built[name] = stage(result.select(*columns) if columns else result, name)
        return self

    def var(self, name: str, default: object = None) -> object:
        return self.params.get(name, default)

    def now(self) -> dt.datetime:
        given = self.params.get("now")
        return given if given is not None else dt.datetime.combine(self.as_of, dt.time())

    def table(self, name: str) -> str:
        return f"{self.database}.{name}" if self.database else name

    def target(self, name: str) -> DataFrame:
        """The stored table of a model, as it was before this run."""
        return self.spark.table(self.table(name))

    def is_incremental(self, name: str) -> bool:
        return self.database is not None and not self.full_refresh and tables.exists(self.spark, self.table(name))

    def with_params(self, **params) -> Context:
        return Context(
            self.spark, self.sources, self.as_of, {**self.params, **params}, self.database, self.full_refresh
        )


def select_models(select: str | None = None) -> list[Model]:
    """Models by ``tag:x``, ``path:folder/...``, name, or all, each after the models it reads."""
    order = [MODELS[n] for n in TopologicalSorter({m.name: m.after for m in MODELS.values()}).static_order()]
    if select is None:
        return order
    kind, _, value = select.rpartition(":")
    tests = {
        "tag": lambda m: value in m.tags,
        "path": lambda m: m.path == value or m.path.startswith(value.rstrip("/") + "/"),
        "": lambda m: m.name == value,
    }
    if kind not in tests:
        raise ValueError(f"unknown selection {select!r}")
    return [m for m in order if tests[kind](m)]


def run(ctx: Context, select: str | None = None) -> list[str]:
    """Build and store the selected models in order; returns the names of those stored."""
    stored = []
    for m in select_models(select):
        if m.materialized == "ephemeral":
            continue
        if m.pre:
            m.pre(ctx)
        store(ctx, m)
        if m.post:
            m.post(ctx)
        stored.append(m.name)
    return stored


def store(ctx: Context, m: Model) -> None:
    table = ctx.table(m.name)
    if m.materialized == "view":
        ctx.ref(m.name).createOrReplaceTempView(m.name)
        return
    incremental = m.materialized == "incremental" and ctx.is_incremental(m.name)
    df = m.build(ctx)
    if m.unique_key and not incremental:
        df = compact(df, m.unique_key, m.version, m.tie)  # a keyed table holds each key once from its first run on
    if incremental and m.unique_key:
        if m.partition_by:
            ts, grain = m.partition_by
            df = df.withColumn(f"part_{ts}", tables.grain_of(df[ts], grain))
        tables.merge(df, table, m.unique_key, m.version, m.fixed_partition, m.tie)
    else:
        mode = "append" if incremental else "overwrite"
        if m.partition_by:
            tables.write_partitioned(df, table, *m.partition_by, mode, m.sort_by)
        else:
            tables.write(df, table, mode, sort_by=m.sort_by)
    ctx._built[m.name] = ctx.spark.table(table).select(*df.columns)


def run_slice(ctx: Context, name: str, start: dt.date, end: dt.date) -> None:
    """Run one model for one window; its rows replace those of the window, or merge by key if it has one."""
    m = MODELS[name]
    sliced = ctx.with_params(start_date=start, end_date=end)
    if m.unique_key or not sliced.is_incremental(name) or not m.partition_by:
        store(sliced, m)
        return
    tables.replace_slice(m.build(sliced), ctx.table(name), *m.partition_by, start, end)


def backfill(ctx: Context, name: str, start: dt.date, end: dt.date, one_by_one: bool = False) -> None:
    """Fill a sliced model over months: one job for the whole range, or one commit per month."""
    windows = month_windows(start, end) if one_by_one else [(start, end)]
    for first, last in windows:
        run_slice(ctx, name, first, last)


def slice_of(ctx: Context, df: DataFrame, ts: str) -> DataFrame:
    """The rows of the window in the run's parameters, or all rows without one."""
    start, end = ctx.var("start_date"), ctx.var("end_date")
    return df if start is None and end is None else date_slice(df, ts, start, end)
