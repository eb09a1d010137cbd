"""Greedy hold-off: golden times, random sequences, block cuts, alerts."""

import random
import re
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickspark.operators import fleet, holdoff
from tickspark.schema import TRADE

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
RULE = fleet.AlertRule(up_delay=16.0, down_delay=1.0)


def trades(spark, times, product="A"):
    rows = [(i, START + timedelta(microseconds=t), product, 1.0, 1.0, "buy", None, None) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, TRADE)


def greedy(times, hold):
    kept, ready = [], None
    for t in sorted(times):
        if ready is None or t >= ready:
            kept.append(t)
            ready = t + hold
    return kept


def kept_micros(frame):
    return sorted(r[0] for r in frame.select(F.unix_micros("time")).collect())


def offset(times):
    base = int(START.timestamp() * 1_000_000)
    return [base + t for t in times]


def test_golden_times(spark):
    times = [0, 400_000, 900_000, 1_000_000, 1_500_000, 2_000_000, 2_900_000, 5_000_000, 5_990_000, 6_000_000]
    found = kept_micros(holdoff.throttle_min_gap(trades(spark, times), 1.0))
    assert found == offset([0, 1_000_000, 2_000_000, 5_000_000, 6_000_000])


@pytest.mark.parametrize("seed,block", [(1, 3), (2, 10), (3, 50), (4, 100_000)])
def test_dense_sequences_in_blocks(spark, seed, block):
    """No gap ever reaches the hold-off, so nothing but the step tables can cut the sequence."""
    rng = random.Random(seed)
    times, at = [], 0
    for _ in range(400):
        at += rng.randrange(0, 400_000)
        times.append(at)
    found = kept_micros(holdoff.throttle_min_gap(trades(spark, times), 1.0, block_rows=block))
    assert found == offset(greedy(times, 1_000_000))


def test_many_events_in_one_instant(spark):
    times = [0] * 300 + [500_000] * 100 + [1_000_000] * 100
    kept = holdoff.throttle_min_gap(trades(spark, times), 1.0, block_rows=10).collect()
    assert sorted(r["trade_id"] for r in kept) == [0, 400]


def test_random_variable_holds(spark):
    rng = random.Random(11)
    rows = [("k", rng.randrange(60_000_000), i, rng.choice([100_000, 900_000, 2_000_000])) for i in range(300)]
    frame = spark.createDataFrame(rows, "key string, us long, id long, hold long").withColumn("at", F.timestamp_micros("us"))
    kept = holdoff.greedy_holdoff(frame, ["key"], "at", "id", F.col("hold"), 2_000_000, block_rows=7)
    want, ready = [], -1
    for _, us, i, hold in sorted(rows, key=lambda r: (r[1], r[2])):
        if us >= ready:
            want.append(i)
            ready = us + hold
    assert [r["id"] for r in kept.orderBy("us").collect()] == want


@pytest.mark.parametrize("seed,fan", [(21, 2), (22, 3), (23, 5)])
def test_step_tables_in_a_tree(spark, seed, fan):
    """Many blocks of one key, several levels of joined tables, gaps and dense stretches."""
    rng = random.Random(seed)
    rows, at = [], 0
    for i in range(500):
        at += rng.choice([0, 1_000, 50_000, 300_000]) if rng.random() < 0.98 else 9_000_000
        rows.append((rng.choice("ab"), at, i, rng.choice([200_000, 900_000, 1_500_000])))
    frame = spark.createDataFrame(rows, "key string, us long, id long, hold long").withColumn("at", F.timestamp_micros("us"))
    kept = holdoff.greedy_holdoff(frame, ["key"], "at", "id", F.col("hold"), 1_500_000, block_rows=6, fan=fan)
    want = []
    for key in "ab":
        ready = -1
        for k, us, i, hold in sorted(rows, key=lambda r: (r[1], r[2])):
            if k == key and us >= ready:
                want.append(i)
                ready = us + hold
    assert sorted(r["id"] for r in kept.collect()) == sorted(want)


def golden_ticks(spark):
    text = (Path(__file__).parent / "golden_ticks.txt").read_text()
    rows = [
        ("f", datetime.fromisoformat(f"2026-07-25T{clock}+00:00"), int(level), float(cpu))
        for clock, level, cpu in re.findall(r"(\d\d:\d\d:\d\d\.\d{3}),(\d),([\d.]+)", text)
    ]
    assert len(rows) == 96
    return spark.createDataFrame(rows, "fleet string, ts timestamp, level int, cpu double")


GOLDEN_EVENTS = [
    ("12:46:05.224", "scale_down", 2, 1, "CPU 0.2% < 10% for 60s"),
    ("12:46:36.450", "scale_up", 1, 2, "CPU 40.3% > 20%"),
    ("12:48:09.407", "scale_down", 2, 1, "CPU 0.0% < 10% for 60s"),
    ("12:51:28.027", "scale_up", 1, 2, "CPU 20.4% > 20%"),
    ("12:53:15.987", "scale_down", 2, 1, "CPU 0.0% < 10% for 60s"),
    ("13:01:24.401", "scale_up", 1, 2, "CPU 32.0% > 20%"),
    ("13:03:13.087", "scale_down", 2, 1, "CPU 0.0% < 10% for 60s"),
    ("13:06:17.147", "scale_up", 1, 2, "CPU 97.2% > 20%"),
    ("13:08:05.646", "scale_down", 2, 1, "CPU 0.0% < 10% for 60s"),
]


@pytest.mark.parametrize("block", [2, 100_000])
def test_golden_alerts(spark, block):
    found = fleet.hysteresis_alerts(golden_ticks(spark), RULE, block).withColumn(
        "clock", F.date_format("timestamp", "HH:mm:ss.SSS")
    )
    rows = found.orderBy("timestamp").collect()
    assert [(r["clock"], r["action"], r["old_capacity"], r["new_capacity"], r["reason"]) for r in rows] == GOLDEN_EVENTS


def test_low_run_crosses_parts(spark):
    ticks = spark.createDataFrame(
        [("f", START + timedelta(hours=h), 2, cpu) for h, cpu in enumerate([50, 5, 5, 5, 5, 50, 5, 5])],
        "fleet string, ts timestamp, level int, cpu long",
    )
    found = fleet.low_since(ticks, F.col("cpu") < 10, part_seconds=7200).orderBy("ts").collect()
    base = int(START.timestamp() * 1_000_000)
    hours = [None if r["low_since"] is None else (r["low_since"] - base) // 3_600_000_000 for r in found]
    assert hours == [None, 1, 1, 1, 1, None, 6, 6]


def test_fleet_average_ignores_instances_without_data(spark):
    rows = [("f", "a", 0, 10.0), ("f", "a", 30, 20.0), ("f", "b", 10, 40.0), ("f", "c", 5, None), ("g", "a", 5, None)]
    samples = spark.createDataFrame(rows, "fleet string, instance_id string, s long, cpu double").withColumn(
        "ts", F.timestamp_seconds("s")
    )
    found = {r["fleet"]: r["cpu"] for r in fleet.fleet_average(samples).collect()}
    assert found == {"f": 30.0, "g": 0.0}
