"""Validation and normalisation of trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.numeric import finite, given_number, parsed
from ..functions.times import parse_iso
from ..schema import OTHER_PRICE_CAP, PRICE_BOUNDS

UNKNOWN_PRODUCT = "unknown"
SPACE = " \t\n\r\x0b\x0c"


def _bound(product: Column, bounds, position: int, default: float) -> Column:
    expr = None
    for row in bounds:
        hit = product == F.lit(row[0])
        value = F.lit(row[position])
        expr = F.when(hit, value) if expr is None else expr.when(hit, value)
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def price_is_sane(product: Column, price: Column, bounds=PRICE_BOUNDS, cap: float = OTHER_PRICE_CAP) -> Column:
    """Positive and within the inclusive bounds of its product; NULL when the price is no number."""
    product = F.coalesce(product, F.lit(""))
    return (
        (price > 0)
        & (price >= _bound(product, bounds, 1, 0.0))
        & (price <= _bound(product, bounds, 2, cap))
    )


def price_sanity_filter(trades: DataFrame, bounds=PRICE_BOUNDS, cap: float = OTHER_PRICE_CAP) -> DataFrame:
    """Keep trades with a believable price. A missing price counts as zero and is dropped."""
    if trades.schema["price"].dataType == T.DoubleType():
        trades = trades.filter(F.col("price") > 0)  # plain enough to reach the Parquet scan
    return trades.filter(price_is_sane(F.col("product"), given_number("price"), bounds, cap))


def sanity_counters(trades: DataFrame, bounds=PRICE_BOUNDS, cap: float = OTHER_PRICE_CAP) -> DataFrame:
    """Valid, skipped and unreadable rows of :func:`price_sanity_filter`, in one pass."""
    sane = price_is_sane(F.col("product"), given_number("price"), bounds, cap)
    return trades.agg(
        F.count_if(sane).alias("valid"),
        F.count_if(~sane).alias("skipped"),
        F.count_if(sane.isNull()).alias("rejected"),
    )


def clean_side(side: Column) -> Column:
    """Lower case without surrounding white space; the usual values need no work."""
    tidy = F.lower(F.btrim(side, F.lit(SPACE)))
    return F.when(side.isin("buy", "sell"), side).otherwise(tidy)


def with_defaults(trades: DataFrame) -> DataFrame:
    """Default product, cleaned side, parsed numbers; :func:`is_normal` tells which rows are usable."""
    return trades.withColumns(
        {
            "product": F.coalesce("product", F.lit(UNKNOWN_PRODUCT)),
            "price": parsed("price"),
            "size": parsed("size"),
            "side": clean_side(F.coalesce("side", F.lit(""))),
            "latency_ms": parsed("latency_ms"),
        }
    )


def is_normal() -> Column:
    """Whether a row of :func:`with_defaults` has a product, a positive price and readable numbers."""
    return (
        (F.col("product") != UNKNOWN_PRODUCT)
        & F.coalesce(F.col("price") > 0, F.lit(False))
        & finite("price")
        & finite("size")
        & finite("latency_ms")
    )


def normalize_trades(trades: DataFrame) -> DataFrame:
    """Fill defaults, clean the side, and drop rows without a product, price or readable number."""
    return with_defaults(trades).filter(is_normal())


def require_product(trades: DataFrame) -> DataFrame:
    return trades.filter(F.length("product") > 0)


def usable_for_windows(trades: DataFrame) -> DataFrame:
    """Rows a window summary can use: a product, a price and a size that are finite numbers."""
    return finite_trades(require_product(trades))


def finite_trades(trades: DataFrame) -> DataFrame:
    """Rows whose price and size are numbers; a NaN or an infinity drops that record only."""
    return trades.filter(finite("price") & finite("size"))


def event_time_fallback(trades: DataFrame) -> DataFrame:
    """Event time is the processing time, else the trade time; rows with neither are dropped."""
    return trades.withColumn("event_time", F.coalesce("processed_at", "time")).filter(
        F.col("event_time").isNotNull()
    )


def stamp_processed(trades: DataFrame, at: Column | None = None) -> DataFrame:
    return trades.withColumn("processed_at", F.current_timestamp() if at is None else at)


def type_trades(raw: DataFrame) -> DataFrame:
    """String-typed records to the trade schema. Unreadable values become NULL, not errors."""
    return raw.select(
        F.col("trade_id").try_cast("long").alias("trade_id"),
        parse_iso("time").alias("time"),
        "product",
        F.col("price").try_cast("double").alias("price"),
        F.col("size").try_cast("double").alias("size"),
        "side",
        parse_iso("processed_at").alias("processed_at"),
        F.col("latency_ms").try_cast("double").alias("latency_ms"),
    )


def reject_reason(raw: DataFrame) -> DataFrame:
    """String-typed records with the ``reason`` why each can't be used, null for those that can."""

    def junk(name: str) -> Column:
        return F.col(name).isNotNull() & given_number(name).isNull()

    reason = (
        F.when(F.col("_corrupt_record").isNotNull(), F.lit("malformed json"))
        .when(junk("price"), F.lit("price is not a number"))
        .when(junk("size"), F.lit("size is not a number"))
        .when(junk("latency_ms"), F.lit("latency is not a number"))
    )
    return raw.withColumn("reason", reason)


def split_rejects(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split string-typed records into (readable, rejected with a reason)."""
    marked = reject_reason(raw)
    good = marked.filter(F.col("reason").isNull()).drop("reason", "_corrupt_record")
    return good, marked.filter(F.col("reason").isNotNull())
