"""Streaming forms of the log operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import windows
from millrace.operators.validation import Contract, split_counts
from millrace.session import scratch_path

BATCH = "batch"  # partition of the tables that batches write


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, files: str = "*", per_trigger: int = 100):
    """Parquet files of a folder as a stream, at most ``per_trigger`` files per micro-batch.

    The number of files per batch changes no result, only how often results are stored.
    """
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", per_trigger)
        .option("pathGlobFilter", files)
        .parquet(folder)
    )


def stream_table(spark: SparkSession, path: str, per_trigger: int = 100) -> DataFrame:
    """A stored table as a stream, whether it is a folder of files or a single file."""
    schema = spark.read.parquet(path).schema
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.getFileStatus(place).isDirectory():
        return read_stream(spark, path, schema, per_trigger=per_trigger)
    return read_stream(spark, str(place.getParent()), schema, place.getName(), per_trigger)


def running_counts(logs: DataFrame, key: str) -> DataFrame:
    """Count per key since the start of the stream."""
    return logs.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"))


def window_cells(logs: DataFrame, width: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Counts per (window, facet, value) over a stream, emitted once the watermark has passed the window.

    The state holds one row per distinct value of a window, spread over all state partitions: a busy
    window is no single row of state, and nothing is sketched.
    """
    return windows.window_cells(logs.withWatermark("timestamp", delay), width)


def window_features(logs: DataFrame, width: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Exact features of all windows that close over the available input.

    The cells of a window are emitted together, when it closes; the batch operator turns closed windows into
    features, with exact distinct counts and the exact percentile, as in a batch run.
    """
    return windows.features_of_cells(run_to_table(window_cells(logs, width, delay), "cells"))


def alert_sessions(
    logs: DataFrame, key: str, min_rate: float, width: str = "5 minutes", delay: str = "10 minutes"
) -> DataFrame:
    """Per key, runs of windows whose 5xx rate reaches ``min_rate``, as sessions."""
    failing = (
        logs.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", width).alias("w"), F.col(key))
        .agg(F.count("*").alias("requests"), F.count_if(F.col("status") >= 500).alias("errors"))
        .where(F.col("errors") / F.col("requests") >= min_rate)
        .select(F.window_time("w").alias("t"), "w", key, "requests", "errors")
    )
    return (
        failing.groupBy(F.session_window("t", width).alias("s"), F.col(key))
        .agg(
            F.count("*").alias("window_count"),
            F.sum("requests").alias("request_count"),
            F.sum("errors").alias("error_count"),
            F.min("w.start").alias("start"),
            F.max("w.end").alias("end"),
        )
        .select(key, "start", "end", "window_count", "request_count", "error_count")
    )


def quarantine(
    raw: DataFrame, contract: Contract, position: str, valid_path: str, invalid_path: str, manifest_path: str, checkpoint: str
) -> StreamingQuery:
    """Valid and invalid rows of each micro-batch to two tables that change together.

    Each batch overwrites its own partition in both tables and then writes its line of the manifest.
    ``committed`` reads only batches with such a line: one that died between the two writes is not seen, and
    when it is replayed it replaces what it left behind.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        tagged = contract.tag(batch, position).persist()
        try:
            parts = {valid_path: contract.valid(tagged, [position]), invalid_path: contract.invalid(tagged, position)}
            for path, rows in parts.items():
                rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
            counts = split_counts(tagged).withColumn("batch_no", F.lit(batch_id).cast("bigint"))
            counts.coalesce(1).write.mode("overwrite").parquet(f"{manifest_path}/{BATCH}={batch_id}")
        finally:
            tagged.unpersist()

    return each_batch(raw, split, checkpoint)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per committed batch: ``batch_no``, ``total``, ``valid``, ``invalid``."""
    return spark.read.schema("batch_no bigint, total bigint, valid bigint, invalid bigint").parquet(path).select(
        "batch_no", "total", "valid", "invalid"
    )


def committed(spark: SparkSession, path: str, manifest_path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of a table written by batches, of committed batches only: other partitions are not even listed for reading."""
    known = manifest(spark, manifest_path).select(F.col("batch_no").alias(BATCH))
    stored = spark.read.schema(schema).parquet(path)
    if BATCH not in stored.columns:  # no batch has ever been written
        return stored.limit(0)
    return stored.join(F.broadcast(known), BATCH, "left_semi").drop(BATCH)


def each_batch(
    stream: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Process all available input, then stop: one run of a recurring job."""
    return (
        stream.writeStream.foreachBatch(action)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_to_table(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run over all available input and return what was emitted.

    In ``complete`` mode the table holds the result of the last batch.
    """
    spark = stream.sparkSession
    folder = scratch_path(spark, label)
    schema = stream.schema
    # without any input no batch runs: the table is then there, and empty
    spark.createDataFrame([], schema).write.parquet(f"{folder}/rows" if mode == "complete" else f"{folder}/rows/batch=-1")

    def store(batch: DataFrame, batch_id: int) -> None:
        target = f"{folder}/rows" if mode == "complete" else f"{folder}/rows/batch={batch_id}"
        batch.write.mode("overwrite").parquet(target)

    each_batch(stream, store, f"{folder}/checkpoint", mode).awaitTermination()
    return spark.read.schema(schema).parquet(f"{folder}/rows").select(*schema.names)
