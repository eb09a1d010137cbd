"""Rolling snapshots and sliding windows against plain Python, with hot slots and small blocks."""

import math
import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest

from tickspark.operators import windows
from tickspark.schema import TRADE

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
UTC = timezone.utc


def make(rng, count, spread_seconds, products="AB", hot_slot=0.0):
    """Random trades; a share ``hot_slot`` of them falls into one ten-second slot of product A."""
    rows = []
    for i in range(count):
        hot = rng.random() < hot_slot
        at = START + timedelta(microseconds=rng.randrange(10_000_000) if hot else rng.randrange(spread_seconds * 1_000_000))
        rows.append(
            (i, at, "A" if hot else rng.choice(products), rng.randint(1, 5000) / 100, rng.randint(1, 9) / 100,
             rng.choice(["buy", "sell", "x"]), at, None)
        )
    return rows


def half_up(x, d):
    return math.floor(x * 10**d + 0.5) / 10**d


def brute(rows, n, slot):
    out, kept, done = [], defaultdict(list), set()
    for r in sorted(rows, key=lambda r: (r[6], r[0])):
        kept[r[2]] = (kept[r[2]] + [r])[-n:]
        key = (r[2], int(r[6].timestamp()) // slot)
        if key in done:
            continue
        done.add(key)
        w = kept[r[2]]
        top = sorted(w, key=lambda x: -x[4])[:5]
        out.append(
            (r[2], key[1] * slot, r[0], len(w), half_up(round(sum(x[3] for x in w), 6) / len(w), 2),
             max(x[3] for x in w), min(x[3] for x in w), half_up(round(sum(x[4] for x in w), 6), 4),
             sum(x[5] == "buy" for x in w), sum(x[5] == "sell" for x in w), tuple(x[0] for x in top))
        )
    return sorted(out)


def shown(frame):
    return sorted(
        (r["product"], int(r["window_start"].replace(tzinfo=UTC).timestamp()), r["emitted_by"], r["trade_count"],
         r["avg_price"], r["max_price"], r["min_price"], r["total_volume"], r["buy_count"], r["sell_count"],
         tuple(t["trade_id"] for t in r["top_5_trades"]))
        for r in frame.collect()
    )


@pytest.fixture(autouse=True)
def utc(monkeypatch):
    import time

    monkeypatch.setenv("TZ", "UTC")
    time.tzset()


@pytest.mark.parametrize(
    "n,block,hot", [(1, 5, 0.0), (4, 4, 0.0), (10, 25, 0.0), (10, 10_000, 0.0), (10, 25, 0.4), (3, 3, 0.9)]
)
def test_snapshots_equal_brute_force(spark, n, block, hot):
    rng = random.Random(n * 1000 + block)
    data = make(rng, 300, 120, hot_slot=hot)
    frame = spark.createDataFrame(data, TRADE)
    found = windows.rolling_last_n_snapshot(frame, n, 10, block_rows=block)
    assert shown(found) == brute(data, n, 10)


def test_snapshot_label_lies_after_the_data(spark):
    frame = spark.createDataFrame(make(random.Random(1), 5, 5), TRADE)
    row = windows.rolling_last_n_snapshot(frame, 10, 10).first()
    assert (row["window_end"] - row["window_start"]).total_seconds() == 60
    assert row["generated_at"] >= row["window_start"]


def test_trade_without_price_is_left_out(spark):
    rows = make(random.Random(2), 4, 5, products="A")
    rows[0] = (*rows[0][:3], None, *rows[0][4:])
    found = windows.rolling_last_n_snapshot(spark.createDataFrame(rows, TRADE), 10, 3600).collect()
    assert found[0]["trade_count"] == 1


@pytest.mark.parametrize("size,slide", [(60, 10), (60, 60), (60, 25), (10, 30)])
def test_sliding_windows_equal_brute_force(spark, size, slide):
    data = make(random.Random(size + slide), 200, 300)
    frame = spark.createDataFrame(data, TRADE)
    want = defaultdict(list)
    for r in data:
        at = r[1].timestamp()
        start = int(at // slide) * slide
        while start + size > at:
            want[(r[2], start)].append(r)
            start -= slide
    found = {
        (r["product"], int(r["window_start"].replace(tzinfo=UTC).timestamp())): (r["trade_count"], r["max_price"], r["buy_count"])
        for r in windows.sliding_window_summary(frame, size, slide).collect()
    }
    assert found == {k: (len(v), max(x[3] for x in v), sum(x[5] == "buy" for x in v)) for k, v in want.items()}
    ranked = defaultdict(list)
    for r in windows.top_k_trades_per_window(frame, 3, size, slide).collect():
        ranked[(r["product"], int(r["window_start"].replace(tzinfo=UTC).timestamp()))].append((r["rank"], r["trade_id"]))
    for key, rows in want.items():
        best = sorted(rows, key=lambda x: (-x[4], x[6], x[0]))[:3]
        assert [i for _, i in sorted(ranked[key])] == [b[0] for b in best]


def test_tumbling_counts_add_up(spark):
    data = make(random.Random(9), 500, 1000)
    frame = spark.createDataFrame(data, TRADE)
    assert sum(r["trade_count"] for r in windows.sliding_window_summary(frame, 60, 60).collect()) == 500


def test_nested_top_trades_and_chart_arrays(spark):
    frame = spark.createDataFrame(make(random.Random(4), 100, 100), TRADE)
    summary = windows.sliding_window_summary(frame, 60, 10)
    nested = windows.with_top_trades(summary, windows.top_k_trades_per_window(frame, 5, 60, 10))
    for row in nested.collect():
        sizes = [t["size"] for t in row["top_5_trades"]]
        assert sizes == sorted(sizes, reverse=True) and len(sizes) == min(5, row["trade_count"])
    points = windows.window_history(summary)
    chart = windows.chart_arrays(
        points, ["product"], "recency", {"timestamps": "timestamp", "trade_counts": "trade_count", "avg_prices": "avg_price", "volumes": "volume"}
    )
    for row in chart.collect():
        assert len(row["timestamps"]) == len(row["volumes"]) <= 10
        assert row["timestamps"][0] == max(row["timestamps"])
