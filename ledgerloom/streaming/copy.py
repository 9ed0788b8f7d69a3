"""A continuously maintained copy of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.session import settings

#: Keys of a copy live in RocksDB, on the executors' disks, and a batch adds its own keys to the checkpoint as a change log.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def continuous_copy(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    keys: list[str] | None = None,
    available_now: bool = True,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append new files of a Parquet folder to a target folder as they arrive, however old their rows are.

    With keys, a row whose key has been copied before is not copied again; rows with a null key all are. The keys are
    state of the stream, dealt by their hash: a micro-batch looks up the keys of its own rows only, so its work does not
    grow with what was copied before, and nothing is discarded by time. State and progress are recovered from the
    checkpoint, and the target's own log leaves out files of attempts that did not end. ``files_per_batch`` bounds a
    micro-batch.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(source)
    if keys:
        unknown = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        rows = rows.where(~unknown).dropDuplicates(keys).unionByName(rows.where(unknown))
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    with settings(spark, STATE):
        return writer.start(target)


def read_copy(spark: SparkSession, schema: T.StructType, target: str) -> DataFrame:
    """Rows of a copy: of batches that ended, by the target's log."""
    return spark.read.schema(schema).parquet(target)
