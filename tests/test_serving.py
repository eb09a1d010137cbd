"""Recent views, merged records, percentiles, reports."""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tickspark.functions.numeric import format_money, format_volume, round_half_up
from tickspark.operators import batch, merged, ordered, recent, reports, windows
from tickspark.schema import TRADE
from tickspark.sinks import files
from tickspark.sources import catalog

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(seconds):
    return START + timedelta(seconds=seconds)


def trade(i, seconds, product="A", price=10.0, size=1.0, latency=None):
    return (i, at(seconds - 1), product, price, size, "buy", at(seconds), latency)


def test_unreadable_time_counts_as_recent(spark):
    rows = [(1, ""), (2, "junk"), (3, None), (4, "2024-01-01T00:00:00Z"), (5, "2024-01-01T01:00:00+00:00"), (6, "2024-01-01T00:59:00")]
    frame = spark.createDataFrame(rows, "trade_id long, processed_at string")
    kept = recent.recent_trades(frame, as_of=at(3600), seconds=300)
    assert sorted(r["trade_id"] for r in kept.collect()) == [1, 2, 3, 5, 6]


def test_products_without_recent_trades_fall_back(spark):
    rows = [trade(i, i) for i in range(50)] + [trade(100 + i, 1000 + i, "B") for i in range(3)]
    frame = spark.createDataFrame(rows, TRADE)
    chosen = recent.recent_or_last_n(frame, seconds=10)
    ids = {p: sorted(r["trade_id"] for r in chosen.filter(F.col("product") == p).collect()) for p in "AB"}
    assert ids == {"A": list(range(20, 50)), "B": [100, 101, 102]}
    figures = {r["product"]: r["trades"] for r in recent.recent_summary(chosen).collect()}
    assert figures == {"A": 30, "B": 3}


def test_key_order_scan_limits_before_filtering(spark):
    frame = spark.createDataFrame([trade(i, i, "A" if i % 2 else "B") for i in range(1, 30)], TRADE)
    first = recent.first_n_by_key(frame, 4).collect()
    assert [r["trade_id"] for r in first] == [1, 10, 11, 12]
    scanned = recent.scan_speed_store(frame, "A", 4, scan_order="key")
    assert sorted(r["trade_id"] for r in scanned.collect()) == [1, 11]
    newest = recent.scan_speed_store(frame, "A", 2)
    assert sorted(r["trade_id"] for r in newest.collect()) == [27, 29]


def test_latency_pool(spark):
    frame = spark.createDataFrame([trade(1, 5, latency=200.0), trade(2, 6)], TRADE)
    assert recent.latency_pool_avg(frame).first()["avg_latency"] == pytest.approx((200 + 1000 + 1000) / 3, abs=1e-6)
    assert recent.latency_pool_avg(frame, prefer="computed").first()["avg_latency"] == 1000.0
    assert recent.latency_pool_avg(frame, first_n=1).first()["samples"] == 2


@pytest.mark.parametrize("parts", [1, 3, 40])
@pytest.mark.parametrize("spread", [1.0, 1e-9, 1e300])
def test_percentiles_equal_the_builtin(spark, parts, spread):
    rng = random.Random(5)
    rows = [(k, rng.choice([rng.uniform(-5, 50), 7.0, 7.0, spread * rng.random()])) for k in "abc" for _ in range(rng.randint(1, 400))]
    frame = spark.createDataFrame(rows + [("one", 3.0)], "k string, v double")
    probs = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}
    counted = frame.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    found = {r["k"]: r for r in ordered.exact_percentiles(counted, ["k"], "v", "n", probs, parts).collect()}
    want = {r["k"]: r for r in frame.groupBy("k").agg(*[F.percentile("v", p).alias(c) for c, p in probs.items()]).collect()}
    for k, row in want.items():
        assert [found[k][c] for c in probs] == pytest.approx([row[c] for c in probs], rel=1e-12, abs=1e-9)


def test_percentiles_of_a_narrow_range_are_dealt_evenly(spark):
    counted = spark.range(8000).select(F.lit("a").alias("k"), (1 + F.col("id") * 1e-12).alias("v"), F.lit(1).cast("long").alias("n"))
    dealt = counted.repartitionByRange(8, "k", "v").groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) == 8 and max(r["count"] for r in dealt) < 2000
    found = ordered.exact_percentiles(counted, ["k"], "v", "n", {"p50": 0.5}, 8).first()
    assert found["p50"] == pytest.approx(1 + 3999.5e-12, abs=1e-15)


def test_running_before_across_parts(spark):
    rng = random.Random(6)
    rows = [(k, p, rng.randint(1, 9)) for k in "ab" for p in rng.sample(range(-50, 50), 40)]
    frame = spark.createDataFrame(rows, "k string, p long, n long")
    for r in ordered.running_before(frame, ["k"], "p", "n", "before", width=7).collect():
        assert r["before"] == sum(n for k, p, n in rows if k == r["k"] and p < r["p"])


def test_merged_view_fills_missing_sides(spark):
    speed = spark.createDataFrame([("A", 2, 5.0, 1.0, 3.0)], "product string, trades long, avg_price double, volume double, avg_latency double")
    frame = spark.createDataFrame([trade(i, i, "B", 10.0 + i) for i in range(30)], TRADE)
    summary = batch.batch_summary(frame)
    view = merged.merged_view(speed, summary, windows.sliding_window_summary(frame, 10, 10))
    got = {r["product"]: r.asDict(recursive=True) for r in view.collect()}
    assert got["A"]["batch_layer"]["trades"] == 0 and got["A"]["batch_layer"]["status"] == merged.BATCH_ABSENT
    assert got["A"]["window_metrics"] == []
    assert got["B"]["speed_layer"] == {"trades": 0, "avg_price": 0.0, "volume": 0.0, "avg_latency": 0.0}
    assert got["B"]["batch_layer"]["trades"] == 30 and got["B"]["batch_layer"]["status"] == merged.BATCH_PRESENT
    starts = [w["window_start"] for w in got["B"]["window_metrics"]]
    assert starts == sorted(starts, reverse=True) and len(starts) == 4


def test_history_as_arrays(spark):
    frame = spark.createDataFrame([trade(i, 60 * i) for i in range(100)], TRADE)
    points = recent.minute_of_day_history(frame)
    row = windows.chart_arrays(
        points.withColumn("all", F.lit(0)), ["all"], "minute", {"timestamps": "minute", "trades": "trades", "prices": "price", "volumes": "volume"}
    ).first()
    assert row["timestamps"] == [f"01:{m:02d}" for m in range(20, 40)] and row["trades"] == [1] * 20


def test_formats_and_rounding(spark):
    frame = spark.createDataFrame([("12.5",), ("abc",), (None,), ("NaN",)], "x string")
    shown = [tuple(r) for r in frame.select(format_money("x"), format_volume("x")).collect()]
    assert shown == [("$12.50", "12.5000")] + [("$0.00", "0.0000")] * 3
    values = spark.createDataFrame([(0.125,), (-0.125,), (1e18,), (2.5,)], "x double")
    assert [r[0] for r in values.select(round_half_up(F.col("x"), 2)).collect()] == [0.13, -0.12, 1e18, 2.5]


RUNS = {
    1: [0.48065185546875, 0.31256675720214844, 0.29015541076660156, 0.3216266632080078, 0.28252601623535156],
    2: [0.8072853088378906, 0.5691051483154297, 0.530242919921875, 0.5161762237548828, 0.6799697875976562],
    4: [0.8120536804199219, 2.9191970825195312, 0.7379055023193359, 0.8528232574462891, 0.9527206420898438],
    8: [1.1572837829589844, 0.8947849273681641, 0.8833408355712891, 0.9222030639648438, 1.2006759643554688],
}
SPEEDUPS = {
    1: (1.0, 100.0, 0.3375053405761719),
    2: (0.5438758260335024, 27.19379130167512, 0.6205558776855469),
    4: (0.2689414089216506, 6.723535223041265, 1.2549400329589844),
    8: (0.33361613876319757, 4.17020173453997, 1.01165771484375),
}


@pytest.fixture
def stats(spark):
    rows = [("x", w, i, t) for w, times in RUNS.items() for i, t in enumerate(times)]
    return reports.run_stats(spark.createDataFrame(rows, "name string, workers int, iteration int, time_ms double"), ["name", "workers"])


def test_golden_runs_and_speedups(stats):
    assert {r["workers"]: r["times"] for r in stats.collect()} == RUNS
    found = {r["workers"]: (r["speedup"], r["efficiency"], r["time_ms"]) for r in reports.relative_to_baseline(stats, ["name"]).collect()}
    for workers, want in SPEEDUPS.items():
        assert found[workers] == pytest.approx(want, rel=1e-12)
    best = reports.best_parallel(stats, ["name"]).first()
    assert (best["best_workers"], best["best_ms"]) == (2, pytest.approx(0.6205558776855469))


def test_report_document_and_csv(spark, folder, stats):
    speedups = reports.relative_to_baseline(stats, ["name"])
    minutes = spark.createDataFrame([(f"12:{38 + i}", n) for i, n in enumerate([1, 53, 50, 51, 51, 16])], "timestamp string, trades_per_minute long")
    latency = spark.createDataFrame([(10, 500.0), (50, 600.0)], "rate_bucket int, avg_latency double")
    summary = reports.series_summary(minutes, latency, speedups)
    row = summary.first()
    assert (row["peak_throughput"], row["avg_throughput"], row["total_trades"], row["avg_latency"]) == (53, 37.0, 222, 550.0)
    tiers = reports.scaling_tier(summary).first()
    assert (tiers["scaling_tier"], tiers["throughput_tier"]) == ("limited", "high")
    path = files.write_json(reports.report_document(stats, speedups, summary), f"{folder}/report")
    document = json.loads(spark.read.text(path).first()[0])
    assert [r["workers"] for r in document["results"]] == [1, 2, 4, 8]
    assert document["summary"]["best_speedup"] == 1.0
    table = spark.read.option("header", True).csv(files.write_csv(stats, f"{folder}/runs"))
    assert {int(r["workers"]): json.loads(r["times"]) for r in table.collect()} == RUNS


def test_tiers_are_exclusive(spark):
    frame = spark.createDataFrame([(3.0, 50), (3.01, 51), (1.5, 30), (1.51, 31)], "s double, p long")
    found = [tuple(r)[2:] for r in reports.scaling_tier(frame, "s", "p").collect()]
    assert found == [("good", "moderate"), ("excellent", "high"), ("limited", "low"), ("good", "moderate")]


def test_runs_without_limit(spark):
    frame = spark.range(1000).selectExpr("'x' AS name", "id % 2 AS workers", "cast(id AS double) AS time_ms")
    assert "times" not in reports.run_stats(frame, ["name", "workers"], keep_times=False).columns


def test_trend_line(spark):
    series = spark.createDataFrame([("s", d, 3.0 + 2.0 * i) for i, d in enumerate("abcd")], "g string, d string, y double")
    rows = reports.trend_line(series, ["g"], "d", "y").orderBy("d").collect()
    assert rows[0]["slope"] == pytest.approx(2.0) and [r["fitted"] for r in rows] == pytest.approx([3, 5, 7, 9])


def test_sql_statements(spark):
    frame = spark.createDataFrame([trade(1, 0, "BTC-USD"), trade(2, 100, "BTC-USD", 20.0, latency=4.0), trade(3, 100, "X")], TRADE)
    catalog.register_views(frame, "trades", "speed_trades", "my_trades")
    assert tuple(catalog.recent_totals(spark, catalog.newest()).first()) == (2, 15.0, 2.0)
    assert catalog.recent_count(spark, catalog.newest(), view="my_trades").first()[0] == 2
    assert tuple(catalog.latency_avg_p95(spark, catalog.newest("speed_trades")).first()) == (4.0, 4.0)
    assert tuple(recent.latency_tail(frame).first()) == (4.0, 4.0)
    none = catalog.recent_totals(spark, "timestamp'2030-01-01'").first()
    assert tuple(none) == (0, 0.0, 0.0)
