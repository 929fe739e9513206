"""Driving streaming jobs: named folders, resumption, and sinks a repeated batch cannot double.

The caller names a folder for each job. It holds the job's checkpoint and its tables, so
calling a job again with that folder goes on where the last run ended, wherever it was stopped. State is
kept in RocksDB, outside the executors' heap.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """RocksDB for a query started inside, unless the session names another store."""
    named = spark.conf.get(_STORE, None)
    default = named is None or named.endswith("HDFSBackedStateStoreProvider")
    if default:
        spark.conf.set(_STORE, ROCKSDB)
    try:
        yield
    finally:
        if default:
            spark.conf.unset(_STORE) if named is None else spark.conf.set(_STORE, named)


def start_appending(stream: DataFrame, folder: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append what is available to the table ``folder/data``; the file sink's log keeps a repeated batch out."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/data")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _rocksdb(stream.sparkSession):
        return writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()


def start_batches(stream: DataFrame, folder: str, write: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Hand every micro-batch and its number to ``write``; a batch cut off half-way is handed over again under its number."""
    with _rocksdb(stream.sparkSession):
        return (
            stream.writeStream.outputMode(mode)
            .foreachBatch(write)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )


def finish(query: StreamingQuery) -> None:
    try:
        query.awaitTermination()
    finally:
        query.stop()


def run_available(stream: DataFrame, folder: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Process everything available and not yet processed; the whole table so far."""
    finish(start_appending(stream, folder, partition_by))
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/data")


# ------------------------------------------------------------- batch-numbered tables


def replace_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    """The rows of one batch in a folder of their own: writing the same batch again replaces them."""
    batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All batches of a table written by ``replace_batch``; without one yet, an empty table."""
    if not _folders(spark, path, "batch"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(path).drop("batch")


def _filesystem(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, path: str, name: str, complete: bool = False) -> list[int]:
    where, fs = _filesystem(spark, path)
    if not fs.exists(where):
        return []
    found = []
    for status in fs.listStatus(where):
        key, _, value = status.getPath().getName().partition("=")
        done = not complete or fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
        if key == name and value.lstrip("-").isdigit() and done:
            found.append(int(value))
    return sorted(found)


def newest(spark: SparkSession, path: str, schema: StructType, below: int | None = None) -> DataFrame:
    """The newest complete version (older than ``below``) of a table written by ``upsert``; else an empty table."""
    known = [v for v in _folders(spark, path, "version", complete=True) if below is None or v < below]
    if not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/version={known[-1]}")


def upsert(changes: DataFrame, path: str, version: int, keys: Sequence[str]) -> None:
    """A new version of a table with one row a key, in which the changed rows replace the old ones.

    It is made from the newest version before it, so writing a version again gives the same
    table. Only the version before the new one is kept beside it. The changes are written first and read
    back: each use of a stateful batch runs its state store anew, and two uses at once wait for each other.
    """
    spark, schema, staged = changes.sparkSession, changes.schema, f"{path}/changes"
    changes.write.mode("overwrite").parquet(staged)
    changes = spark.read.schema(schema).parquet(staged)
    old = newest(spark, path, schema, below=version)
    old.join(changes.select(*keys), list(keys), "left_anti").unionByName(changes).write.mode("overwrite").parquet(f"{path}/version={version}")
    for gone in _folders(spark, path, "version")[:-2]:
        where, fs = _filesystem(spark, f"{path}/version={gone}")
        fs.delete(where, True)


# -------------------------------------------------------------------------- replays


def replay(events: DataFrame, job: Callable[[DataFrame], DataFrame], folder: str, ts: str, far) -> DataFrame:
    """``job`` over everything available, windows still open at the end included.

    The job runs twice on one checkpoint: over the events, then over a single row of time ``far``,
    which moves the watermark past every window. It ends a history for good: events that come later are late.
    """
    spark = events.sparkSession
    spark.createDataFrame([], events.schema).write.mode("append").parquet(f"{folder}/end")
    stream = job(events.unionByName(spark.readStream.schema(events.schema).parquet(f"{folder}/end")))
    run_available(stream, folder)
    last = [tuple(far if f.name == ts else None for f in events.schema)]
    spark.createDataFrame(last, events.schema).write.mode("append").parquet(f"{folder}/end")
    return run_available(stream, folder)
