"""Per-product batch aggregation, in one pass or from mergeable partials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import exact_sum, exact_total, joined_total, number_or, odd_total, round_half_up
from ..schema import OTHER_PRICE_CAP, PRICE_BOUNDS
from .quality import (
    UNKNOWN_PRODUCT,
    is_normal,
    normalize_trades,
    price_is_sane,
    price_sanity_filter,
    with_defaults,
)

METRICS = (
    "count",
    "price_sum",
    "price_max",
    "price_min",
    "volume",
    "latency_sum",
    "latency_count",
    "buy_count",
    "sell_count",
)

ODD = ("price_odd", "volume_odd", "latency_odd")


def valid_trades(trades: DataFrame, bounds=PRICE_BOUNDS, cap: float = OTHER_PRICE_CAP) -> DataFrame:
    return normalize_trades(price_sanity_filter(trades, bounds, cap))


def product_partials(trades: DataFrame, *more_keys: str | Column) -> DataFrame:
    """Mergeable per-product sums over normalised trades, optionally split by further keys."""
    price, size, latency = F.col("price"), F.col("size"), F.col("latency_ms")
    timed = latency > 0
    return trades.groupBy("product", *more_keys).agg(
        F.count(F.lit(1)).alias("count"),
        exact_total(price).alias("price_sum"),
        odd_total(price).alias("price_odd"),
        F.max(price).alias("price_max"),
        F.min(price).alias("price_min"),
        exact_total(size).alias("volume"),
        odd_total(size).alias("volume_odd"),
        exact_total(F.when(timed, latency)).alias("latency_sum"),
        odd_total(F.when(timed, latency)).alias("latency_odd"),
        F.count_if(timed).alias("latency_count"),
        F.count_if(F.col("side") == "buy").alias("buy_count"),
        F.count_if(F.col("side") == "sell").alias("sell_count"),
    )


def merge_partials(partials: DataFrame, *keys: str) -> DataFrame:
    """Combine partials of any split of the rows; the result does not depend on the split."""
    merged = {
        name: F.max(name) if name == "price_max" else F.min(name) if name == "price_min" else F.sum(name)
        for name in (*METRICS, *ODD)
    }
    return partials.groupBy(*(keys or ("product",))).agg(*[agg.alias(name) for name, agg in merged.items()])


def finish_summary(partials: DataFrame) -> DataFrame:
    """Rounded report rows from one partial per product."""
    count = F.col("count").cast("double")
    latency = F.try_divide(joined_total("latency_sum", "latency_odd"), F.col("latency_count").cast("double"))
    return partials.filter((F.col("count") > 0) & (F.col("price_max") > 0)).select(
        "product",
        F.col("count").cast("long").alias("total_trades"),
        round_half_up(joined_total("price_sum", "price_odd") / count, 2).alias("average_price"),
        round_half_up(F.col("price_max"), 2).alias("maximum_price"),
        round_half_up(F.col("price_min"), 2).alias("minimum_price"),
        round_half_up(joined_total("volume", "volume_odd"), 4).alias("total_volume"),
        F.col("buy_count").cast("long").alias("buy_trades"),
        F.col("sell_count").cast("long").alias("sell_trades"),
        F.coalesce(latency, F.lit(0.0)).alias("avg_latency_ms"),
    )


def batch_summary(trades: DataFrame, bounds=PRICE_BOUNDS, cap: float = OTHER_PRICE_CAP) -> DataFrame:
    """Validated, normalised, per-product summary: one scan, one partial and one final aggregate."""
    return finish_summary(product_partials(valid_trades(trades, bounds, cap)))


def daily_partials(trades: DataFrame, bounds=PRICE_BOUNDS, cap: float = OTHER_PRICE_CAP) -> DataFrame:
    """Partials per product and day, the form to store for incremental roll-ups."""
    return product_partials(valid_trades(trades, bounds, cap), F.to_date("time").alias("day"))


def rollup_summary(partials: DataFrame) -> DataFrame:
    """Summary from stored partials; equals :func:`batch_summary` over the same trades."""
    return finish_summary(merge_partials(partials))


def metric_pairs(trades: DataFrame) -> DataFrame:
    """Each normalised trade as up to eight (product, metric, value) rows."""
    price, size, latency, side = (F.col(c) for c in ("price", "size", "latency_ms", "side"))
    one = F.lit(1.0)

    def pair(metric: str, value: Column, when: Column | None = None) -> Column:
        made = F.struct(F.lit(metric).alias("metric"), value.alias("value"))
        return made if when is None else F.when(when, made)

    pairs = F.array(
        pair("count", one),
        pair("price_sum", price),
        pair("price_max", price),
        pair("price_min", price),
        pair("volume", size),
        pair("latency_sum", latency, latency > 0),
        pair("latency_count", one, latency > 0),
        pair("buy_count", one, side == "buy"),
        pair("sell_count", one, side == "sell"),
    )
    return trades.select("product", F.inline(F.filter(pairs, lambda p: p.isNotNull())))


def reduce_pairs(pairs: DataFrame) -> DataFrame:
    """Sum, maximum or minimum per (product, metric), as the metric asks."""
    metric = F.col("metric")
    return (
        pairs.groupBy("product", "metric")
        .agg(exact_sum("value").alias("_sum"), F.max("value").alias("_max"), F.min("value").alias("_min"))
        .select(
            "product",
            "metric",
            F.when(metric == "price_max", F.col("_max"))
            .when(metric == "price_min", F.col("_min"))
            .otherwise(F.col("_sum"))
            .alias("value"),
        )
    )


def reduce_by_metric(trades: DataFrame) -> DataFrame:
    """The reduced pairs without making them first: aggregate once, then unpivot one row per product."""
    wide = product_partials(trades)
    ids = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in METRICS]
    )
    long = wide.select("product", F.inline(ids))
    emitted_only_if_seen = F.col("metric").isin("latency_sum", "latency_count", "buy_count", "sell_count")
    return long.filter(F.col("value").isNotNull() & (~emitted_only_if_seen | (F.col("value") > 0)))


def pivot_metrics(reduced: DataFrame) -> DataFrame:
    """One wide row per product from reduced pairs; absent metrics are zero."""
    wide = reduced.groupBy("product").pivot("metric", list(METRICS)).agg(F.first("value"))
    return wide.na.fill(0.0, list(METRICS))


def avg_latency_by_product(trades: DataFrame) -> DataFrame:
    """Mean of the positive latencies per product, NULL where there are none."""
    return product_partials(trades).select(
        "product",
        F.try_divide(F.col("latency_sum").cast("double"), F.col("latency_count").cast("double")).alias(
            "avg_latency_ms"
        ),
    )


def _raw_columns(trades: DataFrame) -> DataFrame:
    return trades.select(
        F.coalesce("product", F.lit(UNKNOWN_PRODUCT)).alias("product"),
        number_or("price").alias("price"),
        number_or("size").alias("size"),
        "side",
    )


def product_stats_raw(trades: DataFrame) -> DataFrame:
    """Per-product statistics without validation and with exact matching of the side."""
    return (
        _raw_columns(trades)
        .groupBy("product")
        .agg(
            F.count(F.lit(1)).alias("count"),
            exact_sum("price").alias("price_sum"),
            F.max("price").alias("price_max"),
            F.min("price").alias("price_min"),
            exact_sum("size").alias("volume"),
            F.count_if(F.col("side") == "buy").alias("buy_count"),
            F.count_if(F.col("side") == "sell").alias("sell_count"),
        )
    )


def product_sums(trades: DataFrame) -> DataFrame:
    return (
        _raw_columns(trades)
        .groupBy("product")
        .agg(
            F.count(F.lit(1)).alias("count"),
            exact_sum("price").alias("sum_price"),
            exact_sum("size").alias("sum_size"),
        )
    )


def counter_columns(sane: Column) -> list[Column]:
    """Counters over :func:`with_defaults` rows: rows, rows after the price filter, pairs the map phase makes."""
    mapped = F.coalesce(sane, F.lit(False)) & is_normal()
    pairs = (
        F.lit(5)
        + F.when(F.col("latency_ms") > 0, 2).otherwise(0)
        + F.when(F.col("side").isin("buy", "sell"), 1).otherwise(0)
    )
    return [
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(sane).alias("valid_rows"),
        F.count_if(mapped).alias("mapped_rows"),
        F.coalesce(F.sum(F.when(mapped, pairs)), F.lit(0)).alias("pair_count"),
        (F.count_if(sane) == 0).alias("is_empty"),
    ]


def batch_counters(trades: DataFrame, bounds=PRICE_BOUNDS, cap: float = OTHER_PRICE_CAP) -> DataFrame:
    """Rows read, rows after the price filter, and pairs the map phase makes, in one pass.

    ``counters.observed_summary`` has them beside another action, at no pass of their own.
    """
    return with_defaults(trades).agg(*counter_columns(price_is_sane(F.col("product"), F.col("price"), bounds, cap)))
