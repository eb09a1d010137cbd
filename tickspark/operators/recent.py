"""Recent-activity views and minute series."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import (
    SUM_SCALE,
    exact_avg,
    exact_sum,
    finite,
    fraction_part,
    number_or,
    round_half_up,
    whole_part,
)
from ..functions.times import diff_ms, minute_label, minute_of_day, parse_iso
from .ordered import exact_percentiles, settle
from .quality import event_time_fallback, finite_trades

RECENT_SECONDS = 300
FALLBACK_ROWS = 30
SERIES_ROWS = 30
HISTORY_ROWS = 20
SCAN_ROWS = 500


def processed_time(trades: DataFrame) -> Column:
    """``processed_at`` as a timestamp, whether stored typed or as text."""
    if dict(trades.dtypes)["processed_at"] == "string":
        return parse_iso("processed_at")
    return F.col("processed_at")


def as_of_column(trades: DataFrame, as_of: datetime | Column | None) -> Column:
    """The reference instant: as given, else the newest processing time. Never the wall clock."""
    if isinstance(as_of, Column):
        return as_of
    if as_of is not None:
        return F.lit(as_of)
    return trades.select(F.max(processed_time(trades))).scalar()


def _is_recent(trades: DataFrame, as_of, seconds: int) -> Column:
    at = processed_time(trades)
    since = as_of_column(trades, as_of) - F.make_dt_interval(secs=F.lit(seconds))
    return at.isNull() | (at >= since)


def recent_trades(trades: DataFrame, as_of=None, seconds: int = RECENT_SECONDS) -> DataFrame:
    """Trades processed in the last ``seconds``; a missing or unreadable time counts as recent."""
    return trades.filter(_is_recent(trades, as_of, seconds))


def store_key() -> Column:
    return F.concat(F.lit("speed/"), F.col("trade_id").cast("string"), F.lit(".json"))


def _newest_first(trades: DataFrame, scan_order: str) -> list[Column]:
    if scan_order == "key":
        return [store_key().desc()]
    return [processed_time(trades).desc_nulls_last(), F.col("trade_id").desc()]


def newest_per_product(trades: DataFrame, n: int, scan_order: str = "time") -> DataFrame:
    """The last ``n`` trades of each product. Rows are limited before the shuffle."""
    last = Window.partitionBy("product").orderBy(*_newest_first(trades, scan_order))
    return trades.withColumn("_rn", F.row_number().over(last)).filter(F.col("_rn") <= n).drop("_rn")


def recent_or_last_n(
    trades: DataFrame,
    as_of=None,
    seconds: int = RECENT_SECONDS,
    n: int = FALLBACK_ROWS,
    scan_order: str = "time",
) -> DataFrame:
    """Recent trades; a product without any contributes its last ``n`` instead.

    A product's newest time tells whether it is idle. Those times, the recent trades and the last trades of
    idle products are parts of one plan; only the reference instant is looked up ahead of it.
    """
    at = processed_time(trades)
    reference = trades.select(F.max(at)).first()[0] if as_of is None else as_of_column(trades, as_of)
    since = (F.lit(reference).cast("timestamp") if as_of is None else reference) - F.make_dt_interval(secs=F.lit(seconds))
    recent = F.coalesce(at >= since, F.lit(True)) if as_of is None else at.isNull() | (at >= since)
    idle = trades.groupBy("product").agg(F.max(recent).alias("_any")).filter(~F.col("_any")).select(F.col("product").alias("_idle"))
    fresh = trades.filter(recent)
    stale = trades.join(idle, F.col("product").eqNullSafe(F.col("_idle")), "left_semi")
    return fresh.unionByName(newest_per_product(stale, n, scan_order))


def recent_summary(chosen: DataFrame) -> DataFrame:
    """Per-product figures over :func:`recent_or_last_n`; a missing latency counts as zero."""
    latency = number_or("latency_ms")
    # a null number stays a trade without that number; NaN and infinities drop the record
    readable = lambda c: F.col(c).isNull() | finite(c)
    return chosen.filter(readable("price") & readable("size")).groupBy("product").agg(
        F.count(F.lit(1)).alias("trades"),
        round_half_up(exact_avg("price"), 2).alias("avg_price"),
        round_half_up(exact_sum("size"), 4).alias("volume"),
        round_half_up(exact_avg(latency), 0).alias("avg_latency"),
    )


def first_n_by_key(trades: DataFrame, n: int = SCAN_ROWS) -> DataFrame:
    """Bounded scan: the first ``n`` stored records in key order."""
    return trades.withColumn("key", store_key()).orderBy("key").limit(n)


def scan_speed_store(trades: DataFrame, product: str | None = None, limit: int = 100, scan_order: str = "time"):
    """Stored trades of a product, or of every product.

    By default the newest ``limit`` per product. ``scan_order="key"`` bounds the scan before the
    product filter, in string order of the key.
    """
    if scan_order == "key":
        scanned = first_n_by_key(trades, limit).drop("key")
        return scanned if product is None else scanned.filter(F.col("product") == product)
    kept = trades if product is None else trades.filter(F.col("product") == product)
    return newest_per_product(kept, limit)


def latency_per_trade(trades: DataFrame, prefer: str = "pooled") -> DataFrame:
    """Latencies in ms: the stored one and ``processed_at - time``, both when both exist.

    ``prefer="computed"`` takes the stored value only where the times are missing.
    """
    computed = diff_ms("processed_at", "time")
    if prefer == "computed":
        one = F.coalesce(computed, F.col("latency_ms"))
        return trades.withColumn("latency", one).filter(F.col("latency").isNotNull())
    both = F.filter(F.array(F.col("latency_ms"), computed), lambda v: v.isNotNull())
    return trades.withColumn("latency", F.explode(both))


def latency_pool_avg(trades: DataFrame, first_n: int | None = None, prefer: str = "pooled") -> DataFrame:
    """Mean of the pooled latencies, over all trades or over a bounded key-order scan."""
    scanned = trades if first_n is None else first_n_by_key(trades, first_n)
    return latency_per_trade(scanned, prefer).agg(
        F.count("latency").alias("samples"), exact_avg("latency").alias("avg_latency")
    )


def throughput_per_minute(
    trades: DataFrame, take: str | None = "first", n: int = SERIES_ROWS, unit: str = "MINUTE"
) -> DataFrame:
    """Count, mean price and volume per minute (or other unit); the first or last ``n``, or all."""
    timed = event_time_fallback(trades)
    series = (
        finite_trades(timed)
        .groupBy(F.date_trunc(unit, "event_time").alias("at"))
        .agg(
            F.count(F.lit(1)).alias("trades_per_minute"),
            exact_avg("price").alias("avg_price"),
            exact_sum("size").alias("volume"),
        )
    )
    if take is not None:
        series = series.orderBy(F.col("at").asc() if take == "first" else F.col("at").desc()).limit(n)
    return series.select(minute_label("at").alias("timestamp"), "trades_per_minute", "avg_price", "volume")


def minute_of_day_history(trades: DataFrame, n: int = HISTORY_ROWS) -> DataFrame:
    """Per ``HH:MM`` over all days: count, mean price, volume; the last ``n`` labels."""
    at = processed_time(trades)
    return (
        trades.filter(at.isNotNull())
        .groupBy((F.hour(at) * 60 + F.minute(at)).alias("_minute"))
        .agg(
            F.count(F.lit(1)).alias("trades"),
            round_half_up(exact_avg(number_or("price")), 2).alias("price"),
            round_half_up(exact_sum(number_or("size")), 4).alias("volume"),
        )
        .orderBy(F.col("_minute").desc())
        .limit(n)
        .select(minute_of_day(F.timestamp_seconds(F.col("_minute") * 60)).alias("minute"), "trades", "price", "volume")
    )


# Upper ends of the rate buckets; faster traffic falls into the last one.
RATES = (10, 50, 100, 200, 500)


def latency_tail(trades: DataFrame, as_of=None, seconds: int = RECENT_SECONDS) -> DataFrame:
    """Mean and 95th percentile of the stored latency over the last ``seconds``.

    The figures of the SQL statement in ``sources.catalog``, from counts per value: no task holds
    all values, whatever the period.
    """
    at = processed_time(trades)
    since = as_of_column(trades, as_of) - F.make_dt_interval(secs=F.lit(seconds))
    counted = settle(
        trades.filter((at >= since) & F.col("latency_ms").isNotNull())
        .groupBy(F.lit(0).alias("_all"), "latency_ms")
        .agg(F.count(F.lit(1)).alias("n")),
        "counts",
    )
    mean = counted.groupBy("_all").agg(_weighted_mean("latency_ms", "n").alias("avg_latency"))
    tail = exact_percentiles(counted, ["_all"], "latency_ms", "n", {"p95_latency": 0.95})
    return mean.join(tail, "_all").drop("_all")


def _weighted_mean(value: str, freq: str) -> Column:
    n = F.col(freq).cast("decimal(19,0)")
    whole = F.sum(whole_part(value).cast("decimal(19,0)") * n).cast("double")
    fraction = F.sum(fraction_part(value).cast("decimal(9,0)") * n).cast("double")
    return (whole + fraction / F.lit(float(SUM_SCALE))) / F.sum(freq)


def latency_by_rate(trades: DataFrame, rates=RATES, unit: str = "MINUTE") -> DataFrame:
    """Measured latency per observed ingestion rate (trades per minute, or other unit).

    The rates, one row per minute, are kept as a small table, so that trades usually meet them
    without a shuffle. Percentiles come from counts per (bucket, value): no task sees all trades
    of a bucket.
    """
    timed = trades.withColumn("at", F.date_trunc(unit, "time")).filter(F.col("at").isNotNull())
    rate = settle(timed.groupBy("at").agg(F.count(F.lit(1)).alias("rate")), "rates")
    bucket = F.lit(rates[-1])
    for top in reversed(rates[:-1]):
        bucket = F.when(F.col("rate") <= top, F.lit(top)).otherwise(bucket)
    counted = settle(
        latency_per_trade(timed.join(rate, "at"))
        .groupBy(bucket.cast("int").alias("rate_bucket"), "latency")
        .agg(F.count(F.lit(1)).alias("n")),
        "counts",
    )
    means = counted.groupBy("rate_bucket").agg(
        F.sum("n").alias("samples"), _weighted_mean("latency", "n").alias("avg_latency")
    )
    tails = exact_percentiles(
        counted, ["rate_bucket"], "latency", "n", {"p95_latency": 0.95, "p99_latency": 0.99}
    )
    return means.join(tails, "rate_bucket")
