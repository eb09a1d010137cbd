"""Record schemas of the trade pipeline and the trades view over an ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: A raw feed message. Numbers travel as quoted strings, so every field is read as a string.
RAW_MESSAGE = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("type", "time", "product_id", "price", "size", "side", "trade_id")
    ]
)

#: Scan schema of stored trade JSON. Strings everywhere, because a quoted number read as double is NULL.
TRADE_JSON = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "time",
            "product",
            "price",
            "size",
            "side",
            "trade_id",
            "received_at",
            "processed_at",
            "latency_ms",
            "_corrupt_record",
        )
    ]
)

#: A processed trade, the row type every operator works on.
TRADE = T.StructType(
    [
        T.StructField("trade_id", T.LongType()),
        T.StructField("time", T.TimestampType()),
        T.StructField("product", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("size", T.DoubleType()),
        T.StructField("side", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("latency_ms", T.DoubleType()),
    ]
)

BATCH_SUMMARY = T.StructType(
    [
        T.StructField("product", T.StringType()),
        T.StructField("total_trades", T.LongType()),
        T.StructField("average_price", T.DoubleType()),
        T.StructField("maximum_price", T.DoubleType()),
        T.StructField("minimum_price", T.DoubleType()),
        T.StructField("total_volume", T.DoubleType()),
        T.StructField("buy_trades", T.LongType()),
        T.StructField("sell_trades", T.LongType()),
        T.StructField("avg_latency_ms", T.DoubleType()),
    ]
)

# Inclusive price bounds per product, and the cap for any other product.
PRICE_BOUNDS = (
    ("BTC-USD", 1000.0, 200000.0),
    ("ETH-USD", 10.0, 10000.0),
    ("SOL-USD", 1.0, 500.0),
    ("DOGE-USD", 0.001, 1.0),
)
OTHER_PRICE_CAP = 1000000.0

# Bounds for the trades view over the events table, chosen so that the price filter drops rows.
EVENT_PRICE_BOUNDS = (
    ("click", 1.0, 200.0),
    ("error", 5.0, 150.0),
    ("purchase", 0.5, 300.0),
    ("signup", 2.0, 250.0),
)


EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def trades_from_events(events: DataFrame) -> DataFrame:
    """Project an events table (batch or streaming) to processed trades."""
    event_id = F.col("event_id")
    side = (
        F.when(event_id % 11 == 0, F.lit(" BUY "))
        .when(event_id % 13 == 0, F.lit("unknown"))
        .when(F.col("user_id") % 2 == 0, F.lit("buy"))
        .otherwise(F.lit("sell"))
    )
    time = F.col("ts").cast("timestamp")
    return events.select(
        event_id.cast("long").alias("trade_id"),
        time.alias("time"),
        F.col("event_type").alias("product"),
        F.col("value").alias("price"),
        (F.get_json_object("props", "$.k").cast("int").cast("double") / 100).alias("size"),
        side.alias("side"),
        F.timestamp_add("MILLISECOND", ((event_id * 37) % 5000).cast("int"), time).alias("processed_at"),
        F.when(event_id % 3 == 0, ((event_id * 13) % 900).cast("double")).alias("latency_ms"),
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def read_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_from_events(read_events(spark, sf_dir))
