"""Batch writers with several outputs, flushes with timers, bounded state, counters and reports."""

import functools
import json
import os
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tests.test_streams import feed, run, same, stream, trades  # noqa: F401
from tickspark.operators import batch, counters, holdoff, windows
from tickspark.plans import queries as q
from tickspark.schema import EVENT_PRICE_BOUNDS as BOUNDS, TRADE
from tickspark.sources import stores
from tickspark.streaming import batches, feeds, flush, state

START = datetime(2024, 1, 1)


def plain_batches(times, rows, micros):
    done, held = [], []
    for i, t in enumerate(times):
        if held and t >= times[held[0]] + micros:
            done.append((held[0], i, flush.BY_TIME))
            held = []
        held.append(i)
        if len(held) == rows:
            done.append((held[0], i + 1, flush.BY_COUNT))
            held = []
    return done, held[0] if held else len(times)


def test_cuts_equal_a_plain_walk():
    rng = np.random.default_rng(1)
    for _ in range(60):
        us = np.cumsum(rng.choice([0, 1, 5, 40], size=rng.integers(1, 200)))
        rows, micros = int(rng.integers(1, 12)), int(rng.integers(1, 60))
        assert flush.cut_batches(us, rows, micros) == plain_batches(us.tolist(), rows, micros)


def ticks(spark, folder, number, seconds, product="A"):
    """A file of trades so many seconds after the start, read in one micro-batch."""
    rows = [(1000 * number + i, START + timedelta(seconds=s), product, 1.0, 1.0, "buy", START, None) for i, s in enumerate(seconds)]
    spark.createDataFrame(rows, TRADE).coalesce(1).write.mode("append").parquet(folder)


def test_both_branches_over_batches_and_restarts(spark, folder):
    out, checkpoint, clock, source = (f"{folder}/{n}" for n in ("out", "checkpoint", "clock", "in"))
    os.makedirs(source)
    marks = feeds.clock_marks(spark, clock)
    rows = spark.readStream.schema(TRADE).parquet(source)

    def go():
        flow = flush.flush_count_or_time(rows, 3, 60, delay="10 seconds", marks=marks)
        feeds.run_available(spark, flow.writeStream.format("parquet").option("path", out), checkpoint)
        found = spark.read.schema(flow.schema).parquet(out).groupBy("flush", "reason").agg(F.sort_array(F.collect_list("trade_id")).alias("ids"))
        return {r["flush"]: (r["reason"], r["ids"]) for r in found.collect()}

    ticks(spark, source, 0, [0, 1])
    assert go() == {}
    ticks(spark, source, 1, [2, 3])  # the third trade closes the batch, the fourth opens one
    assert go() == {0: ("count", [0, 1, 1000])}
    ticks(spark, source, 2, [100])  # a minute later: the open batch closes without it
    assert go()[1] == ("time", [1001])
    ticks(spark, source, 3, [101])  # only appended to what is held
    assert len(go()) == 2
    feeds.put_clock_mark(spark, clock, START + timedelta(seconds=300))  # nothing comes: the timer closes it
    assert go()[2] == ("time", [2000, 3000])
    ticks(spark, source, 4, [400, 401, 402])
    assert go()[3] == ("count", [4000, 4001, 4002])


LATE = [[0, 10, 100], [95, 20, 75, 55, 110], [300], [290, 10, 250]]


def test_windows_and_late_rows_add_up(spark, folder):
    write = batches.put_windows_and_late(folder, 60, 20, delay_seconds=30)
    frames = []
    for number, seconds in enumerate(LATE):
        rows = [(10 * number + i, START + timedelta(seconds=s), "A", 1.0, 1.0, "buy", START, None) for i, s in enumerate(seconds)]
        frames.append(spark.createDataFrame(rows, TRADE))
        write(frames[-1], number)
    write(frames[1], 1)  # a retry changes nothing
    found = batches.read_windows(spark, folder, 60, 20, 30)
    late = batches.read_late(spark, folder, TRADE)
    pairs = 3 * sum(f.count() for f in frames)
    assert found.agg(F.sum("trade_count")).first()[0] + late.agg(F.sum("missed")).first()[0] == pairs
    assert {r["trade_id"]: r["missed"] for r in late.collect()} == expected_late(LATE)
    closed = batches.read_windows(spark, folder, 60, 20, 30, closed=True)
    assert closed.agg(F.max(F.unix_seconds("window_end"))).first()[0] <= START.timestamp() + 270 + 24 * 3600
    everything = frames[0].union(frames[1]).union(frames[2]).union(frames[3])
    assert found.count() <= windows.sliding_window_summary(everything, 60, 20).count()


@pytest.mark.parametrize("cuts", [[[0, 1, 2, 3]], [[0, 1], [2, 3]], [[0], [1, 2, 3]]])
def test_polls_of_one_batch_have_their_own_watermarks(spark, folder, cuts):
    """However polls are dealt to batches, windows and late trades are those of a batch for each poll."""
    polls = []
    for number, seconds in enumerate(LATE):
        rows = [(10 * number + i, START + timedelta(seconds=s), "A", 1.0, 1.0, "buy", START, None) for i, s in enumerate(seconds)]
        polls.append(spark.createDataFrame(rows, TRADE))
        batches.put_windows_and_late(f"{folder}/apart", 60, 20, delay_seconds=30)(polls[-1], number)
    write = batches.put_windows_and_late(f"{folder}/together", 60, 20, delay_seconds=30)
    for number, group in enumerate(cuts):
        frames = [polls[n].withColumn("poll", F.lit(n).cast("long")) for n in group]
        write(functools.reduce(DataFrame.union, frames), number)
    for closed in (False, True):
        got, want = (batches.read_windows(spark, f"{folder}/{n}", 60, 20, 30, closed) for n in ("together", "apart"))
        same(got, want)
    late = batches.read_late(spark, f"{folder}/together", TRADE)
    assert {r["trade_id"]: r["missed"] for r in late.collect()} == expected_late(LATE)


def expected_late(groups, size=60, slide=20, delay=30):
    newest, out = None, {}
    for number, seconds in enumerate(groups):
        for i, s in enumerate(seconds):
            starts = [k * slide for k in range((s - size) // slide + 1, s // slide + 1)]
            missed = 0 if newest is None else sum(k + size <= newest - delay for k in starts)
            if missed:
                out[10 * number + i] = missed
        newest = max([newest or 0, *seconds])
    return out


def test_good_trades_and_dead_letters_add_up(spark, folder):
    lines = [
        {"trade_id": 1, "time": "2024-01-01T00:00:00Z", "product": "A", "price": "5", "size": 1},
        {"trade_id": 2, "time": "2024-01-01T00:00:01Z", "product": "", "price": 5, "size": 1},
        {"trade_id": 3, "time": "2024-01-01T00:00:02Z", "price": 5, "size": 1},
        {"trade_id": 4, "time": "2024-01-01T00:00:02Z", "product": "A", "price": "x", "size": 1},
        {"trade_id": 1, "time": "2024-01-01T00:00:03Z", "product": "A", "price": "7", "size": 1},
    ]
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/a.json", "w") as out:
        out.write("\n".join(json.dumps(x) for x in lines) + '\n{"trade_id": 5, "pro')
    raw = stores.scan_trade_json(spark, f"{folder}/in", multi_line=False)
    write = batches.put_enriched(f"{folder}/out", F.col("time"))
    for _ in range(2):  # the second run is a retry
        write(raw, 0)
        good = stores.read_appended(spark, f"{folder}/out/good", TRADE)
        letters = spark.read.parquet(f"{folder}/out/rejects")
        assert good.count() + letters.count() == 6
        assert sorted(r["reason"] for r in letters.collect()) == [
            "malformed json", "price is not a number", "product is missing", "product is missing",
        ]
    write(raw, 1)
    first = batches.first_arrivals(stores.read_appended(spark, f"{folder}/out/good", TRADE)).collect()
    assert [(r["trade_id"], r["price"]) for r in first] == [(1, 5.0)]


@pytest.mark.parametrize("key", [None, "product"])
def test_throttle_in_batches(spark, feed, trades, folder, key):  # noqa: F811
    write = batches.put_throttled(folder, 300, key)
    feeds.run_available(spark, stream(spark, feed).writeStream.foreachBatch(write))
    got = stores.read_appended(spark, f"{folder}/kept", TRADE).drop("batch_id")
    same(got, holdoff.throttle_min_gap(trades, 300, key))


def test_throttle_takes_many_polls_in_few_batches_and_reads_each_clock_once(spark, sf_dir, trades, folder, monkeypatch):  # noqa: F811
    reads = []
    monkeypatch.setattr(batches, "read_appended", lambda *a: reads.append(a) or stores.read_appended(*a))
    write, ids = batches.put_throttled(folder, 300), []

    def counted(rows, batch_id):
        ids.append(batch_id)
        write(rows, batch_id)

    q.run_polls(spark, q.one_shard(spark, sf_dir), lambda s: s.drop("poll").writeStream.foreachBatch(counted), 50)
    got = stores.read_appended(spark, f"{folder}/kept", TRADE).drop("batch_id")
    same(got, holdoff.throttle_min_gap(trades, 300, None))
    assert len(ids) <= 7 and len(reads) == 1  # 20 polls
    batches.put_throttled(folder, 300)(trades.filter(F.lit(False)), ids[-1] + 1)  # another writer reads them again
    assert len(reads) == 2


def test_counters_of_many_polls_come_from_few_batches(spark, sf_dir, trades, monkeypatch):  # noqa: F811
    polls, logs = q.run_polls, []

    class Log(counters.CounterLog):
        def __init__(self):
            super().__init__()
            logs.append(self)

    monkeypatch.setattr(counters, "CounterLog", Log)
    monkeypatch.setattr(q, "run_polls", lambda spark, rows, start: polls(spark, rows, start, 50))
    found = q.QUERIES["stream_observed_counters"](spark, sf_dir).first().asDict()
    want = batch.batch_counters(trades, BOUNDS).first().asDict()
    assert found == {k: want[k] for k in found}
    assert 2 <= len(logs[0].rows) <= 7  # 20 polls


def test_closed_batches_come_in_large_pieces():
    frame = pd.DataFrame({"trade_id": range(25_000)})
    processor = flush.CountOrTime(StructType([StructField("trade_id", LongType())]), 20, 60)
    done = [(i, i + 20, flush.BY_COUNT if i % 40 else flush.BY_TIME) for i in range(0, 25_000, 20)]
    pieces = list(processor._closed(frame, 7, done))
    assert len(pieces) == 3
    out = pd.concat(pieces)
    assert out["trade_id"].tolist() == list(range(25_000))
    assert out["flush"].tolist() == [7 + i // 20 for i in range(25_000)]
    assert out["reason"].tolist() == [flush.BY_COUNT if i // 20 % 2 else flush.BY_TIME for i in range(25_000)]


def test_idle_products_leave_no_state(spark, folder):
    source, checkpoint, clock = (f"{folder}/{n}" for n in ("in", "checkpoint", "clock"))
    os.makedirs(source)
    ticks(spark, source, 0, [0, 20], "A")
    ticks(spark, source, 1, [0, 500], "B")
    marks = feeds.clock_marks(spark, clock)
    rows = spark.readStream.schema(TRADE).parquet(source).withColumn("processed_at", F.col("time"))

    def go():
        flow = state.stream_rolling_last_n(rows, 3, 10, idle_seconds=100, delay="0 seconds", marks=marks)
        feeds.run_available(spark, flow.writeStream.format("parquet").option("path", f"{folder}/out"), checkpoint)
        found = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "chunks").load()
        return {r["key"]["product"] for r in found.collect()}

    assert go() == {"B"}  # A has been silent for 480 s
    feeds.put_clock_mark(spark, clock, START + timedelta(seconds=900))
    assert go() == set()
    ticks(spark, source, 2, [1000], "A")
    go()
    found = spark.read.parquet(f"{folder}/out").filter("product = 'A'").orderBy("window_start").collect()
    assert [r["trade_count"] for r in found] == [1, 2, 1]  # it starts afresh


@pytest.mark.parametrize("n", [1, 7])
def test_chunks_hold_no_more_than_needed(spark, feed, trades, folder, n):  # noqa: F811
    flow = state.stream_rolling_last_n(stream(spark, feed).withColumn("processed_at", F.col("time")), n, 3600)
    checkpoint = f"{folder}/checkpoint"
    feeds.run_available(spark, flow.writeStream.format("parquet").option("path", f"{folder}/out"), checkpoint)
    found = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "chunks").load()
    per = {}
    for r in found.collect():
        per.setdefault(r["key"]["product"], []).append(r["user_map_value"]["rows"])
    assert all(sum(sizes) - min(sizes) < n - 1 <= sum(sizes) for sizes in per.values()) and bool(per) == (n > 1)


def test_counters_come_with_the_job(spark, trades, folder):  # noqa: F811
    summary, seen = counters.observed_summary(trades, BOUNDS)
    same(summary, batch.batch_summary(trades, BOUNDS))
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "CollectMetrics" in plan
    summary, seen = counters.observed_summary(trades, BOUNDS)
    summary.write.parquet(f"{folder}/out")
    assert seen.get == batch.batch_counters(trades, BOUNDS).first().asDict()


def test_report_of_cut_files_and_bad_numbers(spark, folder):
    row = {"trade_id": 1, "time": "2024-01-01T00:00:00Z", "product": "A", "price": "5", "size": 1}
    whole = [row, {**row, "trade_id": 2, "price": "x"}, {**row, "trade_id": 3}]
    texts = {
        "whole": json.dumps(whole, indent=2),
        "cut": json.dumps(whole, indent=2)[:-40],
        "empty": "[]",
        "one": json.dumps(row),
        "blank": "",
    }
    for name, text in texts.items():
        with open(f"{folder}/{name}.json", "w") as out:
            out.write(text)
    good, report = stores.scan_with_report(spark, folder)
    assert sorted(r["trade_id"] for r in good.collect()) == ["1", "1", "3"]
    got = {os.path.basename(r["file"])[:-5]: (r["records"], r["rejects"], r["reasons"]) for r in report.collect()}
    assert got == {"whole": (2, 1, "price is not a number"), "cut": (0, 1, "malformed json"), "one": (1, 0, "")}
