"""Streaming sources and sinks of trades."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..schema import EVENTS, TRADE_JSON, trades_from_events
from ..session import scratch_path

MICROS_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
POLL = "1 second"
FLUSH = "60 seconds"
FLUSH_ROWS = 100
FILES_PER_BATCH = 32  # bounds what one micro-batch, and in it one key, can hold


def as_pattern(path: str) -> str:
    """A pattern that matches this path; one that is a pattern already stays as it is."""
    path = path.rstrip("/")
    return path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"


def stream_events(spark: SparkSession, table: str, files_per_batch: int = FILES_PER_BATCH):
    """An events table, one file or a folder of part files, as a stream of processed trades."""
    # a stream's path must be a folder or a pattern; as a pattern for itself it may also be one file
    rows = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_batch).parquet(as_pattern(table))
    return trades_from_events(rows)


def stream_trade_json(spark: SparkSession, folder: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Trade JSON files of a folder as a stream of text-typed records."""
    return spark.readStream.schema(TRADE_JSON).option("maxFilesPerTrigger", files_per_batch).json(folder)


def stream_broker(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", rows_per_batch: int | None = None
) -> DataFrame:
    """Raw messages of a Kafka topic, from the latest offset on, as (raw, timestamp).

    Needs the Kafka connector package on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if rows_per_batch is not None:
        reader = reader.option("maxOffsetsPerTrigger", rows_per_batch)
    return reader.load().select(F.col("value").cast("string").alias("raw"), "timestamp")


def keyed_messages(trades: DataFrame) -> DataFrame:
    """Trades as (key, value) messages keyed by product, the rows a Kafka sink takes."""
    return trades.select(
        F.col("product").alias("key"),
        F.to_json(F.struct(*trades.columns), {"timestampFormat": MICROS_ISO}).alias("value"),
    )


def publish_keyed(trades: DataFrame, servers: str, topic: str) -> DataStreamWriter:
    """Kafka publisher keyed by product, so one product stays in order."""
    return (
        keyed_messages(trades)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
    )


def publish_keyed_files(trades: DataFrame, path: str) -> DataStreamWriter:
    """Messages as files in one folder per product; a busy product is written by many tasks."""
    messages = keyed_messages(trades).withColumnRenamed("key", "product")
    return messages.writeStream.format("json").partitionBy("product").option("path", path)


def raw_batches(trades: DataFrame, path: str, rows: int = FLUSH_ROWS) -> DataStreamWriter:
    """JSON files of at most ``rows`` trades. Start with ``flush_trigger`` to flush by time too."""
    return (
        trades.writeStream.format("json")
        .option("path", path)
        .option("maxRecordsPerFile", rows)
        .option("timestampFormat", MICROS_ISO)
    )


def flush_trigger(writer: DataStreamWriter, every: str = FLUSH) -> DataStreamWriter:
    """Flush by time: a micro-batch, and with it a set of files, at least every ``every``."""
    return writer.trigger(processingTime=every)


def poll_trigger(writer: DataStreamWriter, every: str = POLL) -> DataStreamWriter:
    return writer.trigger(processingTime=every)


def run_available(spark: SparkSession, writer: DataStreamWriter, checkpoint: str | None = None) -> StreamingQuery:
    """Process what is there now, then stop."""
    query = (
        writer.option("checkpointLocation", checkpoint or scratch_path(spark, "stream"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_drained(writer: DataStreamWriter) -> StreamingQuery:
    """Poll until nothing is left, then stop: for sources that bound each poll themselves."""
    query = writer.trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def clock_marks(spark: SparkSession, folder: str) -> DataFrame:
    """Times put into ``folder`` by :func:`put_clock_mark`, as a stream."""
    store = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(store)
    return spark.readStream.schema("time timestamp").parquet(folder)


def put_clock_mark(spark: SparkSession, folder: str, at: datetime) -> None:
    spark.createDataFrame([(at,)], "time timestamp").coalesce(1).write.mode("append").parquet(folder)


def with_clock(trades: DataFrame, delay: str, marks: DataFrame | None = None, key: str = "product") -> DataFrame:
    """The stream behind a watermark that also follows ``marks``, rows that have nothing but a time.

    They count in nothing, but bring a stream that has ended, or is idle, to a close. ``trades`` have a key
    already: tests of the key that come later would move ahead of the watermark and take the marks away,
    which this one, as it names the time, does not.
    """
    if marks is None:
        return trades.withWatermark("time", delay)
    timed = trades.unionByName(marks, allowMissingColumns=True).withWatermark("time", delay)
    return timed.filter(F.col(key).isNotNull() | F.col("time").isNull())


def run_and_close(spark: SparkSession, start: Callable[[DataFrame], DataStreamWriter], at: datetime) -> StreamingQuery:
    """Process what is there, then let the clock pass ``at`` and process what that closes.

    ``start`` makes the stream's writer, given the marks of its clock; both runs share a checkpoint.
    """
    folder, checkpoint = scratch_path(spark, "clock"), scratch_path(spark, "stream")
    marks = clock_marks(spark, folder)
    run_available(spark, start(marks), checkpoint)
    put_clock_mark(spark, folder, at)
    return run_available(spark, start(marks), checkpoint)
