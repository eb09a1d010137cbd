"""Keyed stores written by micro-batches.

A batch only adds its own folder, and writing it again replaces that folder, so a retried batch
changes nothing and the cost of a write follows the batch, not the store. Readers take the last
write per key (``sources.stores``); ``compact_store`` folds the folders now and then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators.batch import product_partials, valid_trades
from ..operators.dedup import dedup_by_trade_id
from ..operators.sketches import SKETCH_K, latency_sketches
from ..schema import OTHER_PRICE_CAP, PRICE_BOUNDS


def put(frame: DataFrame, path: str, batch_id: int, *partitions: str) -> None:
    """Write a batch's own folder of a store, in place of what an earlier try left there."""
    frame.write.mode("overwrite").partitionBy(*partitions).parquet(f"{path}/batch_id={batch_id}")


def upsert_trades(path: str, key=("product", "trade_id")) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of the keyed trade store."""

    def write(batch: DataFrame, batch_id: int) -> None:
        put(dedup_by_trade_id(batch, key), path, batch_id)

    return write


def put_windows(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of window summaries, laid out by product."""

    def write(batch: DataFrame, batch_id: int) -> None:
        put(batch, path, batch_id, "product")

    return write


def put_partials(
    path: str, bounds=PRICE_BOUNDS, cap: float = OTHER_PRICE_CAP
) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of per-product partial sums; history is never read again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        put(product_partials(valid_trades(batch, bounds, cap)), path, batch_id)

    return write


def put_sketches(path: str, k: int = SKETCH_K) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of latency sketches per product and day."""

    def write(batch: DataFrame, batch_id: int) -> None:
        put(latency_sketches(batch, k), path, batch_id)

    return write
