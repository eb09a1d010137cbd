"""Streams over several micro-batches give what the batch operators give; sinks can be retried."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.test_holdoff import GOLDEN_EVENTS, RULE, golden_ticks
from tickspark.operators import batch, dedup, holdoff, windows
from tickspark.schema import EVENT_PRICE_BOUNDS, read_events, read_trades
from tickspark.sinks import appended
from tickspark.sources import stores
from tickspark.streaming import feeds, flows, state

PARTS = 4


@pytest.fixture(scope="module")
def trades(spark, sf_dir):
    return read_trades(spark, sf_dir)


@pytest.fixture(scope="module")
def feed(spark, sf_dir):
    """The events in time order, cut into files that are read one per micro-batch."""
    import tempfile

    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    events = read_events(spark, sf_dir)
    cuts = events.approxQuantile("event_id", [i / PARTS for i in range(PARTS + 1)], 0.0)
    for i in range(PARTS):
        low, high = F.col("event_id") >= cuts[i], F.col("event_id") < cuts[i + 1]
        part = events.filter(low & (high if i < PARTS - 1 else F.lit(True)))
        target = os.path.join(root, f"p{i}")
        part.coalesce(1).write.parquet(target)
        for path in glob.glob(f"{target}/*.parquet"):
            os.utime(path, (1_700_000_000 + 60 * i,) * 2)
    return os.path.join(root, "p*")


def stream(spark, feed):
    return feeds.stream_events(spark, feed, files_per_batch=1)


def run(spark, frame, folder, mode="append"):
    writer = frame.writeStream.format("parquet").outputMode(mode).option("path", f"{folder}/out")
    query = feeds.run_available(spark, writer)
    assert query.lastProgress["batchId"] >= PARTS - 1
    return spark.read.parquet(f"{folder}/out")


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    left, right = (sorted(map(str, x.select(*columns).collect())) for x in (a, b))
    assert left == right


def test_throttle(spark, feed, trades, folder):
    same(run(spark, state.stream_throttle(stream(spark, feed), 300), folder), holdoff.throttle_min_gap(trades, 300))


@pytest.mark.parametrize("n", [1, 10])
def test_rolling_last_n(spark, feed, trades, folder, n):
    # Processing delays reorder trades near the file cuts, so arrival order is the trade time here.
    def plain(t):
        return t.withColumn("processed_at", F.col("time"))

    found = run(spark, state.stream_rolling_last_n(plain(stream(spark, feed)), n, 3600), folder)
    same(found, windows.rolling_last_n_snapshot(plain(trades), n, 3600))


def test_sliding_windows_and_window_store(spark, feed, trades, folder):
    flow = flows.stream_sliding_windows(stream(spark, feed), 3600, 600, delay="1 day")
    store = f"{folder}/store"
    feeds.run_available(spark, flow.writeStream.outputMode("update").foreachBatch(appended.put_windows(store)))
    want = windows.sliding_window_summary(trades, 3600, 600)
    same(stores.scan_window_store(spark, store), want)
    one = stores.scan_window_store(spark, store, "click")
    same(one, want.filter("product = 'click'"))
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(product" in plan
    small = stores.compact_store(stores.scan_window_store(spark, store), f"{folder}/compact", "product")
    same(stores.scan_window_store(spark, small), want)


def test_partials_replace_rereading_history(spark, feed, trades, folder):
    write = appended.put_partials(f"{folder}/partials", EVENT_PRICE_BOUNDS)
    feeds.run_available(spark, stream(spark, feed).writeStream.foreachBatch(write))
    same(
        batch.rollup_summary(stores.read_appended(spark, f"{folder}/partials")),
        batch.batch_summary(trades, EVENT_PRICE_BOUNDS),
    )


def test_upsert_keeps_the_last_write(spark, feed, trades, folder):
    def again(t):
        return t.withColumn("trade_id", F.col("trade_id") % 200)

    write = appended.upsert_trades(f"{folder}/speed")
    feeds.run_available(spark, again(stream(spark, feed)).writeStream.foreachBatch(write))
    want = dedup.dedup_by_trade_id(again(trades))
    same(stores.read_speed_store(spark, f"{folder}/speed"), want)
    write(dedup.dedup_by_trade_id(again(trades)), 0)  # a retried batch replaces its own folder
    same(stores.read_speed_store(spark, f"{folder}/speed"), want)
    compacted = stores.compact_store(stores.read_speed_store(spark, f"{folder}/speed"), f"{folder}/speed2")
    same(stores.read_speed_store(spark, compacted), want)


def test_raw_batches_hold_at_most_100(spark, feed, trades, folder):
    feeds.run_available(spark, feeds.raw_batches(stream(spark, feed), f"{folder}/raw"))
    sizes = [sum(1 for _ in open(p)) for p in glob.glob(f"{folder}/raw/*.json")]
    assert max(sizes) <= 100 and sum(sizes) == trades.count()


def test_keyed_messages(spark, feed, trades, folder):
    feeds.run_available(spark, feeds.publish_keyed_files(stream(spark, feed), f"{folder}/keyed"))
    row = spark.read.json(f"{folder}/keyed").first()
    assert json.loads(row["value"])["product"] == row["product"]
    assert set(feeds.keyed_messages(trades).columns) == {"key", "value"}


def test_enrich_rejects_and_goes_on(spark, folder):
    os.makedirs(f"{folder}/in")
    lines = [
        {"trade_id": 1, "time": "2024-01-01T00:00:00Z", "product": "A", "price": "5", "size": 1},
        {"trade_id": 1, "time": "2024-01-01T00:00:00Z", "product": "A", "price": "5", "size": 1},
        {"trade_id": 2, "time": "2024-01-01T00:00:01Z", "product": "", "price": 5, "size": 1},
        {"trade_id": 3, "time": "2024-01-01T00:00:02Z", "product": "A", "price": "x", "size": 1},
        {"trade_id": 4, "time": "2024-01-01T00:00:03Z", "product": "A", "price": 6, "size": 1},
    ]
    with open(f"{folder}/in/a.json", "w") as out:
        out.write("\n".join(json.dumps(x) for x in lines) + '\n{"trade_id": 5, "pro')
    good, rejected = flows.enrich(feeds.stream_trade_json(spark, f"{folder}/in"))
    for name, frame in (("good", flows.dedup_stream(good)), ("bad", rejected)):
        feeds.run_available(spark, frame.writeStream.format("parquet").option("path", f"{folder}/{name}"))
    kept = spark.read.parquet(f"{folder}/good")
    assert sorted(r["trade_id"] for r in kept.collect()) == [1, 4]
    assert kept.filter("processed_at is null").count() == 0
    assert sorted(r["reason"] for r in spark.read.parquet(f"{folder}/bad").collect()) == [
        "malformed json",
        "price is not a number",
    ]


def test_rows_beyond_the_watermark_are_dropped(spark, folder):
    os.makedirs(f"{folder}/in")
    for i, (clock, trade) in enumerate([("00:00", 1), ("05:00", 2), ("05:01", 3), ("00:01", 4)]):
        path = f"{folder}/in/{i}.json"
        with open(path, "w") as out:
            out.write(json.dumps({"trade_id": trade, "time": f"2024-01-01T{clock}:00Z", "product": "A", "price": 5, "size": 1}))
        os.utime(path, (1_700_000_000 + i,) * 2)
    good, _ = flows.enrich(feeds.stream_trade_json(spark, f"{folder}/in", files_per_batch=1))
    flow = flows.stream_sliding_windows(good, 600, 600, delay="10 minutes")
    writer = flow.writeStream.outputMode("update").foreachBatch(appended.put_windows(f"{folder}/w"))
    feeds.run_available(spark, writer)
    counts = {str(r["window_start"])[11:16]: r["trade_count"] for r in stores.scan_window_store(spark, f"{folder}/w").collect()}
    assert counts == {"00:00": 1, "05:00": 2}


def test_golden_alerts_as_stream(spark, folder):
    ticks = golden_ticks(spark)
    for i in range(3):
        part = ticks.orderBy("ts").offset(32 * i).limit(32)
        part.coalesce(1).write.parquet(f"{folder}/in/p{i}")
        for path in glob.glob(f"{folder}/in/p{i}/*.parquet"):
            os.utime(path, (1_700_000_000 + 60 * i,) * 2)
    flow = spark.readStream.schema(ticks.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/p*")
    feeds.run_available(
        spark, state.stream_alerts(flow, RULE).writeStream.format("parquet").option("path", f"{folder}/out")
    )
    rows = spark.read.parquet(f"{folder}/out").orderBy("timestamp").collect()
    assert [(r["action"], r["old_capacity"], r["new_capacity"], r["reason"]) for r in rows] == [e[1:] for e in GOLDEN_EVENTS]
