"""Percentiles from mergeable sketches, kept per product and day beside the other partial sums.

A sketch is a few thousand values whatever it has seen, so a store of them grows with products and days,
not with trades, and any period is answered by merging its days. ``ordered.exact_percentiles`` stays the
exact form, at the price of reading the trades.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import exact_total, finite, joined_total, odd_total
from .recent import latency_per_trade

SKETCH_K = 4096  # values a sketch keeps at its lowest level; up to so many it is exact
TAILS = {"p50_latency": 0.5, "p95_latency": 0.95, "p99_latency": 0.99}

# Rank error of these sketches at 99 % confidence is the first by k to the power of the second.
ERROR_SCALE, ERROR_POWER = 2.296, 0.9723


def rank_error(k: int = SKETCH_K) -> float:
    """How far the rank of an estimate may be from the wanted one, as a share of all values."""
    return ERROR_SCALE / k**ERROR_POWER


def latency_sketches(trades: DataFrame, k: int = SKETCH_K, day: Column | None = None) -> DataFrame:
    """Sketch, count and exact sum of the pooled latencies per product and day of the trade."""
    pooled = latency_per_trade(trades).filter(finite("latency"))
    return pooled.groupBy("product", (F.to_date("time") if day is None else day).alias("day")).agg(
        F.kll_sketch_agg_double("latency", k).alias("sketch"),
        F.count(F.lit(1)).alias("samples"),
        exact_total("latency").alias("latency_sum"),
        odd_total("latency").alias("latency_odd"),
        F.max("latency").alias("max_latency"),
    )


def merge_sketches(partials: DataFrame, *keys: str, k: int = SKETCH_K) -> DataFrame:
    """One sketch per key from sketches of any split of the trades."""
    return partials.groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch", k).alias("sketch"),
        *[F.sum(c).alias(c) for c in ("samples", "latency_sum", "latency_odd")],
        F.max("max_latency").alias("max_latency"),
    )


def sketched_percentiles(merged: DataFrame, probs: dict[str, float] = TAILS) -> DataFrame:
    """Mean (exact) and percentiles (a stored value each, within :func:`rank_error`) of merged sketches."""
    rest = [c for c in merged.columns if c not in ("sketch", "latency_sum", "latency_odd")]
    return merged.select(
        *rest,
        (joined_total("latency_sum", "latency_odd") / F.col("samples")).alias("avg_latency"),
        *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(name) for name, p in probs.items()],
    )


def rank_errors(trades: DataFrame, estimates: DataFrame, probs: dict[str, float] = TAILS) -> DataFrame:
    """Per product, how far the true rank of each estimate is from the wanted one, as a share of all values.

    An estimate that occurs several times has all ranks of its copies, and the nearest counts.
    """
    pooled = latency_per_trade(trades).filter(finite("latency"))
    both = pooled.select("product", "latency").join(estimates.select("product", *probs), "product")
    counts = [
        F.count_if(test).alias(f"{name}_{end}")
        for name in probs
        for end, test in (("below", F.col("latency") < F.col(name)), ("upto", F.col("latency") <= F.col(name)))
    ]
    found = both.groupBy("product").agg(F.count(F.lit(1)).alias("samples"), *counts)
    n = F.col("samples")
    return found.select(
        "product",
        "samples",
        *[
            F.greatest(F.lit(0.0), F.lit(p) - F.col(f"{name}_upto") / n, F.col(f"{name}_below") / n - F.lit(p)).alias(name)
            for name, p in probs.items()
        ],
    )
