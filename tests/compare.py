"""Runs a query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def normal(rows, columns: list[str]) -> list[tuple]:
    """Rows with columns in name order, as text that keeps the type apart (1 is not 1.0)."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("" if r[i] is None else f"{type(r[i]).__name__}:{r[i]!r}" for i in order) for r in rows)


def compare(spark: SparkSession, connection, build, sql: str, folder: str) -> tuple[int, str]:
    """Number of rows, and what differs ("" if nothing)."""
    df = build(spark, folder)
    start = time.time()
    ours = normal(df.collect(), df.columns)
    compare.seconds = time.time() - start
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = normal(result.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return len(ours), f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(ours) != len(theirs):
        only = sorted(set(ours) - set(theirs))[:2], sorted(set(theirs) - set(ours))[:2]
        return len(ours), f"{len(ours)} rows / {len(theirs)} rows, e.g. {only}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        pair = [(n, x, y) for n, x, y in zip(sorted(names), *wrong[0]) if x != y]
        return len(ours), f"{len(wrong)} rows differ, e.g. {pair}"
    return len(ours), ""
