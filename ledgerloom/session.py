"""Session settings and the shared scratch area.

Everything that must outlive a task (staged frames, checkpoints, scratch tables) goes to the folder the cluster
names in ``spark.checkpoint.dir``. Only a local session without that setting gets a folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",  # no stack capture per column expression
}

_local_scratch: dict[str, str] = {}


def build_session(name: str = "ledgerloom", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can read and write."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.master.startswith("local-cluster") or not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="ledgerloom-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def scratch_database(spark: SparkSession) -> str:
    """A new database whose tables are stored below the shared folder."""
    name = f"scratch_{uuid.uuid4().hex[:12]}"
    location = os.path.join(shared_folder(spark), name)
    spark.sql(f"CREATE DATABASE {name} LOCATION '{location}'")
    return name


_changing = threading.RLock()


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for one action, which takes them when it starts. Threads that need settings take turns."""
    with _changing:
        before = {name: spark.conf.get(name, None) for name in values}
        for name, value in values.items():
            spark.conf.set(name, value)
        try:
            yield
        finally:
            for name, value in before.items():
                if value is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, value)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage at a stored copy, so that later steps neither recompute the input nor depend on the executors
    that produced it, and a table can be rewritten from a frame that was read from it.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_rows(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over the shuffle partitions, for work that is slow per row: a file may be a single split."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
