"""Golden rows of validation and the batch summary, and properties of partials."""

import json
import os
import random

from pyspark.sql import functions as F

from tickspark.operators import batch, dedup, quality
from tickspark.schema import TRADE_JSON
from tickspark.sources import feed, stores

GOLDEN = [
    {"product": "BTC-USD", "price": 50000.0, "size": 0.5, "side": "buy", "latency_ms": 10},
    {"product": "BTC-USD", "price": 60000.0, "size": 0.25, "side": " SELL ", "latency_ms": 0},
    {"product": "BTC-USD", "price": 999.99, "size": 1, "side": "buy"},
    {"product": "BTC-USD", "price": 200000.0, "size": 1.0, "side": "hold"},
    {"product": "ETH-USD", "price": "2500.5", "size": "2", "side": "BUY"},
    {"product": "ETH-USD", "price": 10000.01, "size": 1, "side": "buy"},
    {"product": "XYZ-USD", "price": 1000000, "size": 1, "side": "sell"},
    {"product": "XYZ-USD", "price": 1000000.01, "size": 1, "side": "sell"},
    {"price": 5, "size": 1, "side": "buy"},
    {"product": "DOGE-USD", "price": 0.0, "size": 1, "side": "buy"},
    {"product": "SOL-USD", "price": 1.0, "size": 3, "side": None},
]

SUMMARY = {
    "BTC-USD": (3, 103333.33, 200000.0, 50000.0, 1.75, 1, 1, 10.0),
    "ETH-USD": (1, 2500.5, 2500.5, 2500.5, 2.0, 1, 0, 0.0),
    "SOL-USD": (1, 1.0, 1.0, 1.0, 3.0, 0, 0, 0.0),
    "XYZ-USD": (1, 1000000.0, 1000000.0, 1000000.0, 1.0, 0, 1, 0.0),
}


def put(folder, name, text):
    with open(os.path.join(folder, name), "w") as out:
        out.write(text)


def rows(frame, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in frame.collect()}


def scan(spark, folder, records):
    put(folder, "batch_20240101_000000_11.json", json.dumps(records, indent=2))
    return stores.scan_trade_json(spark, folder)


def test_golden_summary(spark, folder):
    good, _ = quality.split_rejects(scan(spark, folder, GOLDEN))
    found = {r["product"]: tuple(r)[1:] for r in batch.batch_summary(good).collect()}
    assert found == SUMMARY


def test_golden_counters(spark, folder):
    good, _ = quality.split_rejects(scan(spark, folder, GOLDEN))
    assert tuple(quality.sanity_counters(good).first()) == (7, 4, 0)
    counted = batch.batch_counters(good).first()
    assert (counted["rows_read"], counted["valid_rows"], counted["mapped_rows"]) == (11, 7, 6)
    assert counted["pair_count"] == batch.metric_pairs(batch.valid_trades(good)).count()


def test_bad_records_are_rejected_alone(spark, folder):
    put(folder, "a.json", json.dumps([{"product": "SOL-USD", "price": 5, "size": "x"}, {"product": "SOL-USD", "price": 6, "size": 1}]))
    put(folder, "b.json", json.dumps([{"product": "SOL-USD", "price": "NaN", "size": 1}]))
    put(folder, "c.json", '[{"product": "SOL-USD", "price": 7')
    good, rejected = quality.split_rejects(stores.scan_trade_json(spark, folder))
    assert [r["price"] for r in good.collect()] == ["6"]
    assert sorted(r["reason"] for r in rejected.collect()) == [
        "malformed json",
        "price is not a number",
        "size is not a number",
    ]


def test_nan_price_and_unreadable_size_are_dropped(spark):
    frame = spark.createDataFrame(
        [("BTC-USD", float("nan"), 1.0), ("BTC-USD", float("inf"), 1.0), ("BTC-USD", 2000.0, 1.0)],
        "product string, price double, size double",
    ).withColumns({"side": F.lit("buy"), "latency_ms": F.lit(None).cast("double")})
    assert batch.batch_summary(frame).first()["total_trades"] == 1


def test_product_named_like_a_side_keeps_its_row(spark):
    frame = spark.createDataFrame(
        [("BESTBUY-USD", 5.0, 1.0, "buy", 0.0)], "product string, price double, size double, side string, latency_ms double"
    )
    assert batch.batch_summary(frame).first()["total_trades"] == 1


def test_sums_keep_eight_decimals(spark):
    frame = spark.range(100_000).select(
        F.lit("BTC-USD").alias("product"),
        F.lit(2000.0).alias("price"),
        F.lit(0.00000001).alias("size"),
        F.lit("buy").alias("side"),
        F.lit(0.0).alias("latency_ms"),
    )
    assert batch.batch_summary(frame).first()["total_volume"] == 0.001
    assert batch.product_sums(frame).first()["sum_size"] == 0.001


def test_partials_of_any_split_give_the_summary(spark):
    rng = random.Random(3)
    data = [
        (rng.choice(["A", "B", "HOT", "HOT"]), rng.uniform(0.01, 99), rng.randint(1, 10**8) / 1e8, rng.choice(["buy", "sell", ""]), float(rng.randint(0, 3)))
        for _ in range(3000)
    ]
    frame = spark.createDataFrame(data, "product string, price double, size double, side string, latency_ms double")
    whole = sorted(map(tuple, batch.batch_summary(frame).collect()))
    for parts in (1, 2, 17):
        chunk = (F.xxhash64("price", "size") % parts).alias("chunk")
        partials = batch.product_partials(batch.valid_trades(frame), chunk)
        assert sorted(map(tuple, batch.rollup_summary(partials).collect())) == whole
    shuffled = frame.repartition(7, "size")
    assert sorted(map(tuple, batch.batch_summary(shuffled).collect())) == whole


def test_pairs_and_pivot_agree(spark, folder):
    good, _ = quality.split_rejects(scan(spark, folder, GOLDEN))
    valid = batch.valid_trades(good)
    slow, fast = batch.reduce_pairs(batch.metric_pairs(valid)), batch.reduce_by_metric(valid)
    assert sorted(map(tuple, slow.collect())) == sorted(map(tuple, fast.collect()))
    wide = rows(batch.pivot_metrics(fast), "product")
    assert wide["BTC-USD"]["price_max"] == 200000.0 and wide["SOL-USD"]["buy_count"] == 0.0


def test_parse_matches(spark):
    good = {"type": "match", "time": "2024-01-01T00:00:00.5Z", "product_id": "BTC-USD", "price": "1.5", "size": "2", "side": "buy", "trade_id": 7}
    lines = [good, {**good, "type": "heartbeat"}, {**good, "price": "x"}, {k: v for k, v in good.items() if k != "side"}]
    raw = spark.createDataFrame([(json.dumps(m),) for m in lines] + [("not json",)], "raw string")
    found = feed.parse_matches(raw).collect()
    assert [(r["product"], r["price"], r["size"], r["trade_id"]) for r in found] == [("BTC-USD", 1.5, 2.0, 7)]


def test_dedup_keys(spark):
    data = [("A", 1, "2024-01-01 00:00:00", 1.0), ("A", 1, "2024-01-01 00:00:05", 2.0), ("B", 1, "2024-01-01 00:00:09", 3.0)]
    frame = spark.createDataFrame(data, "product string, trade_id long, at string, price double")
    frame = frame.withColumn("processed_at", F.col("at").cast("timestamp"))
    both = dedup.dedup_by_trade_id(frame)
    assert sorted(r["price"] for r in both.collect()) == [2.0, 3.0]
    by_id = dedup.dedup_by_trade_id(frame, key=("trade_id",))
    assert [r["price"] for r in by_id.collect()] == [3.0]


def test_union_pages_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, 2.0)], "id int, x double")
    b = spark.createDataFrame([(2,)], "id int")
    assert sorted(map(tuple, dedup.union_pages(a, b).collect()), key=lambda r: r[0]) == [(1, 2.0), (2, None)]


def test_text_schema_reads_quoted_numbers(spark, folder):
    put(folder, "x.json", '[{"price": "12.5", "size": 3}]')
    row = stores.scan_trade_json(spark, folder).first()
    assert (row["price"], row["size"]) == ("12.5", "3") and TRADE_JSON["price"].dataType.typeName() == "string"
