"""Named queries over the provided tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
MODULES = ("scans", "columns", "rows", "joining", "grouping", "scalars", "upkeep", "storage", "checking", "texts", "marts")


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` is the SQL over the same tables."""

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return build

    return register


def load() -> None:
    for module in MODULES:
        importlib.import_module(f"ledgerloom.catalog.{module}")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
