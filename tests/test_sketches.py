"""Merged sketches stay within their rank error whatever the split; small ones are exact."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickspark.operators import sketches
from tickspark.schema import TRADE
from tickspark.sinks import appended
from tickspark.sources import stores


def trades_of(spark, seed, count=30_000):
    n = F.col("id")
    value = F.exp(F.randn(seed) * 2) * 100
    latency = F.when(n % 3 == 0, F.floor(value / 50) * 50).otherwise(value)  # many ties
    rows = spark.range(count, numPartitions=7).select(
        n.alias("trade_id"),
        F.timestamp_seconds(1_700_000_000 + (n * 37) % (20 * 86_400)).alias("time"),
        F.when(n % 3 == 0, "hot").when(n % 50 == 1, "cold").otherwise("mid").alias("product"),
        F.lit(1.0).alias("price"),
        F.lit(1.0).alias("size"),
        F.lit("buy").alias("side"),
        F.lit(None).cast("timestamp").alias("processed_at"),
        latency.alias("latency_ms"),
    )
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in TRADE.fields])


@pytest.mark.parametrize("split", ["(trade_id * 7919) % 13", "trade_id div 5000", "0"])
def test_any_split_stays_within_the_bound(spark, split):
    trades, k = trades_of(spark, 3).cache(), 200
    partials = sketches.latency_sketches(trades, k, F.expr(split))
    found = sketches.sketched_percentiles(sketches.merge_sketches(partials, "product", k=k)).cache()
    errors = sketches.rank_errors(trades, found).collect()
    assert {r["product"] for r in errors} == {"hot", "mid", "cold"}
    for r in errors:
        assert max(r[c] for c in sketches.TAILS) <= 3 * sketches.rank_error(k)
    exact = {r["product"]: r for r in trades.groupBy("product").agg(F.count("*").alias("n"), F.avg("latency_ms").alias("mean")).collect()}
    for r in found.collect():
        assert r["samples"] == exact[r["product"]]["n"]
        assert np.isclose(r["avg_latency"], exact[r["product"]]["mean"])
    size = partials.agg(F.max(F.length("sketch"))).first()[0]
    assert size < 20_000  # however many values went in


def test_small_sketches_are_exact_and_stored_days_add_up(spark, folder):
    trades = trades_of(spark, 5, 3000)
    for batch in range(3):
        appended.put_sketches(folder)(trades.filter(F.col("trade_id") % 3 == batch), batch)
    appended.put_sketches(folder)(trades.filter(F.col("trade_id") % 3 == 1), 1)  # a retried batch
    merged = sketches.merge_sketches(stores.read_appended(spark, folder), "product")
    values = {}
    for r in trades.collect():
        values.setdefault(r["product"], []).append(r["latency_ms"])
    for r in sketches.sketched_percentiles(merged).collect():
        own = sorted(values.pop(r["product"]))
        assert r["samples"] == len(own) and r["max_latency"] == own[-1]
        for name, p in sketches.TAILS.items():
            assert r[name] == own[int(np.ceil(p * len(own))) - 1]
    assert not values


def test_no_trades(spark):
    none = spark.createDataFrame([], TRADE)
    assert sketches.sketched_percentiles(sketches.merge_sketches(sketches.latency_sketches(none), "product")).collect() == []
