"""Raw feed messages to trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import number
from ..functions.times import parse_iso
from ..schema import RAW_MESSAGE

MATCH = "match"


def parse_matches(messages: DataFrame, raw: str = "raw", received_at: Column | None = None) -> DataFrame:
    """Match messages as trades; other types, and messages lacking a field, are left out."""
    parsed = messages.withColumn("_m", F.from_json(raw, RAW_MESSAGE)).filter(F.col("_m.type") == MATCH)
    received = F.current_timestamp() if received_at is None else received_at
    trades = parsed.select(
        parse_iso("_m.time").alias("time"),
        F.col("_m.product_id").alias("product"),
        number("_m.price").alias("price"),
        number("_m.size").alias("size"),
        F.col("_m.side").alias("side"),
        F.col("_m.trade_id").try_cast("long").alias("trade_id"),
        received.alias("received_at"),
    )
    needed = [F.col(c).isNotNull() for c in ("time", "product", "price", "size", "side", "trade_id")]
    complete = needed[0]
    for test in needed[1:]:
        complete = complete & test
    return trades.filter(complete)
