"""foreachBatch writers with more than one output, or with something to carry from batch to batch.

Everything a batch writes lies in folders that bear its number, so a retried batch replaces what it wrote
and nothing else. What is carried on is read from the folders of earlier batches only: a batch gives the
same however often it is run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.dedup import latest_per_key
from ..operators.holdoff import throttle_min_gap
from ..operators.quality import UNKNOWN_PRODUCT, split_rejects, stamp_processed, type_trades
from ..operators.windows import SLOT_SECONDS, WINDOW_SECONDS, merge_panes, panes_of, windows_closed_by
from ..sinks.appended import put
from ..sources.stores import read_appended

CLOCK = StructType([StructField("us", LongType())])


class _Clock:
    """The greatest time that the batches of a store have kept, in microseconds.

    The folders of all earlier batches are read once, at the writer's first batch or a retried one; after that
    what the batch before has left is still known, so the work of a batch does not grow with their number.
    """

    def __init__(self, path: str):
        self.path, self.through, self.us = f"{path}/clock", None, None

    def before(self, spark: SparkSession, batch_id: int) -> int | None:
        if self.through is None or self.through != batch_id - 1:
            kept = read_appended(spark, self.path, CLOCK).filter(F.col("batch_id") < batch_id)
            self.us = kept.agg(F.max("us")).first()[0]
            self.through = batch_id - 1
        return self.us

    def put(self, frame: DataFrame, batch_id: int) -> None:
        """Write a batch's own time; :meth:`before` was asked for this batch."""
        put(frame, self.path, batch_id)
        own = frame.sparkSession.read.schema(CLOCK).parquet(f"{self.path}/batch_id={batch_id}").first()[0]
        self.us = max((us for us in (self.us, own) if us is not None), default=None)
        self.through = batch_id


# ---- windows, and what comes too late for them --------------------------------------------------


def put_windows_and_late(
    path: str, size: int = WINDOW_SECONDS, slide: int = SLOT_SECONDS, delay_seconds: int = 600
) -> Callable[[DataFrame, int], None]:
    """Writer of window partials (``path/panes``) and of trades too late for some of their windows (``path/late``).

    The watermark of a poll is the newest time of the polls before it less ``delay_seconds``; a window
    whose end it has passed takes nothing more. A late trade says how many of its windows it missed. A batch
    without a column ``poll`` is one poll; of several polls in a batch each has its own watermark.
    """
    clock = _Clock(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = clock.before(batch.sparkSession, batch_id)
        polled = batch if "poll" in batch.columns else batch.withColumn("poll", F.lit(0).cast("long"))
        held = polled.persist()
        try:
            newest_of = held.groupBy("poll").agg(F.max(F.unix_micros("time")).alias("us"))
            # a row for each poll of the batch, of which the source bounds the number
            earlier = F.max("us").over(Window.orderBy("poll").rowsBetween(Window.unboundedPreceding, -1))
            until = F.greatest(F.lit(newest).cast("long"), earlier) - delay_seconds * 1_000_000
            closing = newest_of.select("poll", until.alias("closed_until"))
            timed = held.join(closing, "poll").drop("poll")
            panes = panes_of(timed, size, slide, also=("closed_until",))
            put(panes, f"{path}/panes", batch_id, "product")
            missed = timed.withColumn("missed", windows_closed_by(timed, size, slide, F.col("closed_until")))
            put(missed.filter(F.col("missed") > 0).drop("closed_until"), f"{path}/late", batch_id)
            clock.put(newest_of.agg(F.max("us").alias("us")), batch_id)
        finally:
            held.unpersist()

    return write


def read_windows(
    spark: SparkSession, path: str, size: int = WINDOW_SECONDS, slide: int = SLOT_SECONDS, delay_seconds: int = 600, closed: bool = False
) -> DataFrame:
    """Window summaries so far; with ``closed`` only those that take nothing more."""
    panes = read_appended(spark, f"{path}/panes").drop("batch_id")
    found = merge_panes(panes, size, slide, F.col("closed_until"))
    if closed:
        newest = read_appended(spark, f"{path}/clock", CLOCK).agg(F.max("us")).first()[0]
        found = found.filter(F.unix_micros("window_end") <= F.lit(newest) - delay_seconds * 1_000_000)
    return found


def read_late(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return read_appended(spark, f"{path}/late", StructType([*schema.fields, StructField("missed", LongType())]))


# ---- processed trades, and a dead-letter table for the rest ------------------------------------


def with_reason(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Text-typed records in two: those that become trades, and all others, each with the reason why not."""
    readable, rejected = split_rejects(raw)
    named = F.coalesce(F.length("product") > 0, F.lit(False))
    nameless = readable.filter(~named).withColumns(
        {"_corrupt_record": F.lit(None).cast("string"), "reason": F.lit("product is missing")}
    )
    return readable.filter(named), rejected.unionByName(nameless)


def put_enriched(path: str, stamp: Column | None = None) -> Callable[[DataFrame, int], None]:
    """Writer of processed trades (``path/good``) and dead letters (``path/rejects``) from one reading of a batch.

    Every record of the batch is in exactly one of the two.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            good, rejected = with_reason(held)
            put(stamp_processed(type_trades(good), stamp), f"{path}/good", batch_id)
            put(rejected, f"{path}/rejects", batch_id)
        finally:
            held.unpersist()

    return write


def first_arrivals(store: DataFrame, key=("product", "trade_id")) -> DataFrame:
    """Of trades that arrived several times the first, by batch and then time of processing."""
    ties = [F.col(c).asc_nulls_last() for c in ("processed_at", "time", "price", "size", "side") if c in store.columns]
    return latest_per_key(store, list(key), [F.col("batch_id").asc(), *ties]).drop("batch_id")


# ---- throttling with one clock for all products ------------------------------------------------


def put_throttled(path: str, seconds: float = 1.0, key: str | None = None) -> Callable[[DataFrame, int], None]:
    """Writer (``path/kept``) of trades at least ``seconds`` after the last kept one, of all products or per ``key``.

    What goes from batch to batch is the time from which a trade may be kept again: one number, or one for
    each key. Inside a batch its blocks select in parallel, as over stored trades, so a batch of any size is
    no single task's work. Trades before that time are not kept; batches come in order of time.
    """
    hold = round(seconds * 1_000_000)
    clock = _Clock(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        us = F.unix_micros("time")
        if key is None:
            ready = clock.before(spark, batch_id)
            free = batch if ready is None else batch.filter(us >= ready)
        else:
            schema = StructType([StructField(key, batch.schema[key].dataType), *CLOCK.fields])
            before = read_appended(spark, f"{path}/clock", schema).filter(F.col("batch_id") < batch_id)
            ready = before.groupBy(F.col(key).alias("_key")).agg(F.max("us").alias("_ready"))
            joined = batch.join(ready, F.col(key).eqNullSafe(F.col("_key")), "left")
            free = joined.filter(us >= F.coalesce("_ready", F.lit(-(2**62)))).drop("_key", "_ready")
        put(throttle_min_gap(free, seconds, key), f"{path}/kept", batch_id)
        kept = spark.read.schema(batch.schema).parquet(f"{path}/kept/batch_id={batch_id}")
        until = (F.max(us) + hold).alias("us")
        if key is None:
            clock.put(kept.agg(until), batch_id)
        else:
            put(kept.groupBy(key).agg(until), f"{path}/clock", batch_id)

    return write
