"""Faulty and extreme records, and tables stored as folders."""

import math
import os

import pytest
from pyspark.sql import functions as F

from tickspark.functions.numeric import exact_sum
from tickspark.operators import batch, recent, windows
from tickspark.plans import queries as q
from tickspark.schema import read_trades
from tickspark.sources import stores
from tickspark.streaming import feeds

SCHEMA = (
    "trade_id long, time timestamp, product string, price double, size double, side string, "
    "processed_at timestamp, latency_ms double"
)


def trades(spark, rows):
    """Trades of one product a second apart, from (price, size)."""
    start = 1_700_000_000
    frame = spark.createDataFrame(
        [(i, start + i, "BTC", float(p), float(s)) for i, (p, s) in enumerate(rows)],
        "trade_id long, at long, product string, price double, size double",
    )
    at = F.timestamp_seconds("at")
    return frame.select(
        "trade_id", at.alias("time"), "product", "price", "size", F.lit("buy").alias("side"),
        at.alias("processed_at"), F.lit(1.0).alias("latency_ms"),
    )


@pytest.fixture(scope="module")
def folder_tables(spark, sf_dir):
    """The events table as a folder of part files."""
    import tempfile

    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(4).write.parquet(f"{root}/events.parquet")
    return root


@pytest.mark.parametrize(
    "name",
    ["stream_trades", "sink_raw_batches", "stream_throttle", "stream_sliding_windows", "micro_batch_refresh", "flush_count_or_time"],
)
def test_streams_read_a_table_stored_as_a_folder(spark, sf_dir, folder_tables, name):
    got, want = (q.QUERIES[name](spark, d) for d in (folder_tables, sf_dir))
    columns = [c for c in want.columns if c != "oversized_files"]
    left, right = (sorted(map(str, x.select(*columns).collect())) for x in (got, want))
    assert left == right and left


def test_stream_over_several_micro_batches_has_every_trade(spark, sf_dir, folder_tables):
    stream = feeds.stream_events(spark, f"{folder_tables}/events.parquet", files_per_batch=1)
    out = f"{folder_tables}/out"
    run = feeds.run_available(spark, stream.writeStream.format("parquet").option("path", out))
    assert run.lastProgress["batchId"] >= 3
    assert spark.read.parquet(out).count() == read_trades(spark, sf_dir).count()


@pytest.mark.parametrize(
    "values",
    [[4e-9, 4e-9, 4e-9], [1e19], [1e19, 1e19], [1e300, 1.0], [1e19, -1e19, 2.5], [0.1] * 10 + [-1e-12], [2.0**60, 3.0]],
)
def test_sums_neither_saturate_nor_fail(spark, values):
    for parts in (1, 3):
        frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
        assert frame.agg(exact_sum("x").alias("s")).first().s == pytest.approx(math.fsum(values), rel=1e-12)


def test_tiny_prices_and_huge_sizes_keep_their_product(spark):
    frame = trades(spark, [(4e-9, 1.0), (4e-9, 1e19), (4e-9, 1e19)]).withColumn("product", F.lit("other"))
    (row,) = batch.batch_summary(frame).collect()
    assert row.total_trades == 3 and row.total_volume == pytest.approx(2e19)
    (rolled,) = batch.rollup_summary(batch.daily_partials(frame)).collect()
    assert rolled == row


def test_nan_drops_that_record_only(spark):
    rows = [(10.0, 1.0), (math.nan, 1.0), (20.0, 1.0), (5.0, math.inf), (6.0, 1.0)]
    frame = trades(spark, rows)
    clean = frame.filter(~F.isnan("price") & (F.col("size") < 1e300))
    for build in (
        lambda t: windows.rolling_last_n_snapshot(t, n=10, slot_seconds=1),
        lambda t: windows.sliding_window_summary(t, 60, 10),
        lambda t: windows.top_k_trades_per_window(t, 5, 60, 10),
        recent.throughput_per_minute,
        recent.recent_summary,
    ):
        left, right = (sorted(map(str, build(x).collect())) for x in (frame, clean))
        assert left == right and left


def test_huge_values_in_a_snapshot_leave_later_ones_alone(spark):
    frame = trades(spark, [(1.0, 1e300), (2.0, 3.0), (3.0, 4.0), (4.0, 5.0)])
    got = windows.rolling_last_n_snapshot(frame, n=2, slot_seconds=1).orderBy("emitted_by").collect()
    assert [r.total_volume for r in got] == [1e300, 1e300, 7.0, 9.0]


def test_a_store_without_writes_is_empty(spark, folder):
    schema = trades(spark, []).schema
    assert stores.read_speed_store(spark, os.path.join(folder, "none"), schema=schema).count() == 0


def test_a_tick_without_level_or_reading_does_not_end_the_alert_stream(spark, folder):
    from tickspark.operators import fleet
    from tickspark.streaming import state

    q.stateful(spark)
    rows = [("f", 1_700_000_000 + 60 * i, None if i % 4 == 1 else 1, None if i % 5 == 2 else 90.0) for i in range(40)]
    ticks = spark.createDataFrame(rows, "fleet string, at long, level int, cpu double").select(
        "fleet", F.timestamp_seconds("at").alias("ts"), "level", "cpu"
    )
    ticks.write.parquet(f"{folder}/ticks")
    stream = spark.readStream.schema(ticks.schema).parquet(f"{folder}/ticks")
    got = q.stored(spark, state.stream_alerts(stream, fleet.AlertRule()))
    want = fleet.hysteresis_alerts(ticks, fleet.AlertRule())
    left, right = (sorted(map(str, x.select(*want.columns).collect())) for x in (got, want))
    assert left == right and left


def test_report_rows_hold_every_record(spark):
    from tickspark.operators import reports

    runs = spark.createDataFrame([("a", w, i, 10.0 / w + i) for w in (1, 2, 4) for i in range(3)], "name string, workers int, iteration int, time_ms double")
    stats = reports.run_stats(runs, ["name", "workers"], keep_times=False)
    speedups = reports.relative_to_baseline(stats, ["name"])
    rows = reports.report_rows(stats, speedups, speedups.agg(F.max("speedup").alias("best_speedup"))).collect()
    assert sorted(r.section for r in rows) == ["results"] * 3 + ["speedup"] * 3 + ["summary"]
