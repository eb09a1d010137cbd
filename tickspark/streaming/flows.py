"""Streaming forms of the window summary and of enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.quality import require_product, split_rejects, stamp_processed, type_trades, usable_for_windows
from ..operators.windows import SLOT_SECONDS, WINDOW_SECONDS, finish_windows, window_stats
from .feeds import with_clock


def stream_sliding_windows(
    trades: DataFrame,
    size: int = WINDOW_SECONDS,
    slide: int = SLOT_SECONDS,
    delay: str = "10 minutes",
    marks: DataFrame | None = None,
) -> DataFrame:
    """Sliding window summaries of a stream. Rows later than ``delay`` no longer count.

    With append output a window comes once the watermark has passed its end; ``feeds.run_and_close`` lets it
    pass the last ones. ``sinks.appended.put_windows_and_late`` keeps what comes too late.
    """
    grouped = (
        with_clock(usable_for_windows(trades), delay, marks)
        .groupBy("product", F.window("time", f"{size} seconds", f"{slide} seconds").alias("w"))
        .agg(*window_stats())
    )
    return finish_windows(grouped, F.col("w.start"), F.col("w.end"))


def enrich(raw: DataFrame, stamp: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Text-typed records to (processed trades, rejected records)."""
    good, rejected = split_rejects(raw)
    return stamp_processed(require_product(type_trades(good)), stamp), rejected


def dedup_stream(trades: DataFrame, delay: str = "10 minutes", key=("product", "trade_id")) -> DataFrame:
    """First arrival per key among trades within ``delay`` of each other."""
    return trades.withWatermark("time", delay).dropDuplicatesWithinWatermark(list(key))
