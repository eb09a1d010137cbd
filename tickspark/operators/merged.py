"""Batch, recent and window figures side by side, for all products at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .windows import latest_windows

# Status texts of the batch figures.
BATCH_PRESENT = "batch_available"
BATCH_ABSENT = "Batch processing not yet run. Please run batch processor."

BATCH_NAMES = {
    "total_trades": "trades",
    "average_price": "avg_price",
    "maximum_price": "max_price",
    "minimum_price": "min_price",
    "total_volume": "volume",
    "buy_trades": "buys",
    "sell_trades": "sells",
    "avg_latency_ms": "avg_latency",
}
SPEED_NAMES = ("trades", "avg_price", "volume", "avg_latency")
WINDOW_NAMES = (
    "window_start",
    "window_end",
    "trade_count",
    "avg_price",
    "max_price",
    "min_price",
    "total_volume",
    "buy_count",
    "sell_count",
)


def serve_batch(summary: DataFrame) -> DataFrame:
    """Summary rows under the names the serving side uses."""
    return summary.select("product", *[F.col(c).alias(name) for c, name in BATCH_NAMES.items()])


def lookup_batch_summary(summary: DataFrame, product: str) -> DataFrame:
    return serve_batch(summary.filter(F.col("product") == product)).limit(1)


def default_fill(windows: DataFrame) -> DataFrame:
    """Window rows with missing fields filled and storage-only columns dropped."""
    labels = {"window_start", "window_end"}
    return windows.select(
        "product",
        *[F.col(c) if c in labels else F.coalesce(F.col(c), F.lit(0)).alias(c) for c in WINDOW_NAMES],
    )


def batch_lookup_or_zero(wanted: DataFrame, summary: DataFrame) -> DataFrame:
    """Requested products with their batch figures, zeros and a status where there are none."""
    found = serve_batch(summary).withColumn("_hit", F.lit(True))
    return wanted.select("product").distinct().join(found, "product", "left").select(
        "product",
        *[F.coalesce(F.col(name), F.lit(0)).alias(name) for name in BATCH_NAMES.values()],
        F.when(F.col("_hit"), F.lit(BATCH_PRESENT)).otherwise(F.lit(BATCH_ABSENT)).alias("status"),
    )


def merged_flat(speed: DataFrame, batch: DataFrame) -> DataFrame:
    """Speed and batch figures of every product either side knows, zeros for the missing side."""
    left = speed.select("product", *[F.col(c).alias(f"speed_{c}") for c in SPEED_NAMES])
    right = serve_batch(batch).select(
        "product", *[F.col(c).alias(f"batch_{c}") for c in BATCH_NAMES.values()], F.lit(True).alias("_hit")
    )
    figures = [f"speed_{c}" for c in SPEED_NAMES] + [f"batch_{c}" for c in BATCH_NAMES.values()]
    return left.join(right, "product", "full").select(
        "product",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in figures],
        F.when(F.col("_hit"), F.lit(BATCH_PRESENT)).otherwise(F.lit(BATCH_ABSENT)).alias("status"),
    )


def window_metrics(windows: DataFrame, n: int = 10) -> DataFrame:
    """The newest windows of each product as one array, newest first."""
    entries = default_fill(windows).select("product", F.struct(*WINDOW_NAMES).alias("w"))
    newest = latest_windows(entries.select("product", "w.*"), n)
    ordered = F.array_sort(F.collect_list(F.struct("recency", F.struct(*WINDOW_NAMES).alias("w"))))
    return newest.groupBy("product").agg(ordered.alias("_w")).select(
        "product", F.transform("_w", lambda e: e["w"]).alias("window_metrics")
    )


def merged_view(speed: DataFrame, batch: DataFrame, windows: DataFrame, n: int = 10) -> DataFrame:
    """One nested record per product: recent figures, batch figures, newest windows."""
    flat = merged_flat(speed, batch)
    recent = window_metrics(windows, n)
    empty = F.array().cast(recent.schema["window_metrics"].dataType)
    return flat.join(recent, "product", "left").select(
        "product",
        F.struct(*[F.col(f"speed_{c}").alias(c) for c in SPEED_NAMES]).alias("speed_layer"),
        F.struct(
            *[F.col(f"batch_{c}").alias(c) for c in BATCH_NAMES.values()], F.col("status")
        ).alias("batch_layer"),
        F.coalesce("window_metrics", empty).alias("window_metrics"),
    )


def speed_vs_batch_delta(flat: DataFrame) -> DataFrame:
    """Differences speed minus batch of the figures both sides have."""
    return flat.select(
        "product",
        "speed_trades",
        "batch_trades",
        *[
            (F.col(f"speed_{c}") - F.col(f"batch_{c}")).alias(f"{c}_delta")
            for c in ("trades", "avg_price", "volume", "avg_latency")
        ],
    )
