"""Incremental scoring and deduplication with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gable.operators.relational import first_per_key
from gable.runtime import scratch_path


def _path(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def read_files(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Stream of the parquet files of a folder, or of one file. Whether it is one is asked of the path's own file system."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    system, where = _path(spark, path)
    if system.exists(where) and system.getFileStatus(where).isFile():
        return reader.option("pathGlobFilter", where.getName()).parquet(where.getParent().toString())
    return reader.parquet(path)


def score_stream(rows: DataFrame, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a fitted model's ``transform`` (or any stateless scoring) to a stream of property rows."""
    return score(rows)


def deduplicate_stream(rows: DataFrame, keys: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """First row per key within a window of time: a key may come again after ``delay``, and later rows are dropped.

    State is bounded by the window. For one row per key over all time see ``append_new``.
    """
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def append_new(
    stream: DataFrame, keys: Sequence[str], order: Sequence[Column], sink: str, checkpoint: str | None = None, timeout: float | None = None
) -> DataFrame:
    """Process what is there: of each key that the sink does not hold yet, append the first row of the batch by ``order``.

    Every batch is a folder of the sink, named after its number; a batch that is repeated after a failure is written
    again from the same files against the other folders, so each key has one row whatever fails.
    """
    spark, schema = stream.sparkSession, stream.schema

    def add(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        system, root = _path(session, sink)
        mine = f"batch={number}"
        others = [f"{sink}/{s.getPath().getName()}" for s in system.listStatus(root) if s.getPath().getName() != mine] if system.exists(root) else []
        fresh = first_per_key(batch, keys, order)
        if others:
            known = session.read.schema(schema).parquet(*others).select(*[F.col(k).alias(f"_{k}") for k in keys])
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
            fresh = fresh.join(known, same, "left_anti")
        fresh.select(*schema.names).write.mode("overwrite").parquet(f"{sink}/{mine}")

    where = checkpoint or scratch_path(spark, "stream-state")
    _finish(stream.writeStream.foreachBatch(add).option("checkpointLocation", where).trigger(availableNow=True).start(), timeout)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(sink)


def _finish(running, timeout: float | None) -> None:
    done = running.awaitTermination(timeout) if timeout else (running.awaitTermination(), True)[1]
    if not done:
        running.stop()
        raise TimeoutError("the stream did not finish in time")


def run_available(stream: DataFrame, sink: str, checkpoint: str | None = None, timeout: float | None = None) -> DataFrame:
    """Process what is there, append it as parquet and read the sink back. There is no time limit unless one is given.

    With a fixed ``checkpoint`` a later run only processes files that came since.
    """
    spark = stream.sparkSession
    where = checkpoint or scratch_path(spark, "stream-state")
    running = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", sink)
        .option("checkpointLocation", where)
        .trigger(availableNow=True)
        .start()
    )
    _finish(running, timeout)
    return spark.read.schema(stream.schema).parquet(sink)
