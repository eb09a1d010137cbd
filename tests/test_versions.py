"""Merges switch at once, leave the old version when they fail, and may be repeated."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from tickspark.schema import TRADE
from tickspark.sinks import appended, versions


def batch_of(spark, ids, price):
    at = datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=price)
    return spark.createDataFrame([(i, at, "A", float(price), 1.0, "buy", at, None) for i in ids], TRADE)


def prices(frame):
    return {r["trade_id"]: r["price"] for r in frame.collect()}


def test_readers_see_one_version_during_a_merge(spark, folder):
    write = appended.upsert_trades(folder)
    assert prices(versions.read_store(spark, folder, TRADE)) == {}
    write(batch_of(spark, [1, 2, 3], 10), 0)
    write(batch_of(spark, [2, 4], 20), 1)
    before = versions.read_store(spark, folder, TRADE)
    want = {1: 10.0, 2: 20.0, 3: 10.0, 4: 20.0}
    assert versions.merge_store(spark, folder, TRADE)["through"] == 1
    assert prices(before) == want == prices(versions.read_store(spark, folder, TRADE))
    write(batch_of(spark, [1], 30), 2)
    assert prices(before) == want == prices(versions.read_store(spark, folder, TRADE, version=1))
    assert prices(versions.read_store(spark, folder, TRADE)) == {**want, 1: 30.0}
    write(batch_of(spark, [2, 4], 20), 1)  # a retry of a batch that has been folded
    assert prices(versions.read_store(spark, folder, TRADE)) == {**want, 1: 30.0}
    assert versions.merge_store(spark, folder, TRADE)["version"] == 2
    assert versions.merge_store(spark, folder, TRADE)["version"] == 2  # nothing new


def test_a_failed_merge_leaves_the_old_version(spark, folder, monkeypatch):
    write = appended.upsert_trades(folder)
    write(batch_of(spark, [1, 2], 10), 0)
    versions.merge_store(spark, folder, TRADE)
    write(batch_of(spark, [2], 20), 1)

    def broken(*_):
        raise OSError("no")

    with monkeypatch.context() as m:
        m.setattr(versions, "publish", broken)
        with pytest.raises(OSError):
            versions.merge_store(spark, folder, TRADE)
    assert versions.manifest(spark, folder)["version"] == 1
    assert prices(versions.read_store(spark, folder, TRADE)) == {1: 10.0, 2: 20.0}
    assert len(os.listdir(f"{folder}/_base")) == 2
    versions.merge_store(spark, folder, TRADE)
    assert prices(versions.read_store(spark, folder, TRADE)) == {1: 10.0, 2: 20.0}
    versions.expire_versions(spark, folder, keep=1)
    assert len(os.listdir(f"{folder}/_base")) == 1 and not [n for n in os.listdir(folder) if n.startswith("batch_id")]
    assert prices(versions.read_store(spark, folder, TRADE)) == {1: 10.0, 2: 20.0}
    with pytest.raises(ValueError):
        versions.read_store(spark, folder, TRADE, version=1)


def test_one_of_two_writers_wins(spark, folder):
    appended.upsert_trades(folder)(batch_of(spark, [1], 10), 0)
    versions.merge_store(spark, folder, TRADE)
    with pytest.raises(versions.Lost):
        versions.publish(spark, folder, {"version": 1, "base": "another", "through": 0})
    assert versions.manifest(spark, folder)["base"] != "another"
    assert not [n for n in os.listdir(f"{folder}/_versions") if not n.endswith((".json", ".crc"))]


def test_expiry_keeps_what_two_versions_need(spark, folder):
    write = versions.upsert_and_merge(folder, TRADE, every=2)
    for n in range(7):
        write(batch_of(spark, [n, 100], n), n)
    want = {**{n: float(n) for n in range(7)}, 100: 6.0}
    pinned = prices(versions.read_store(spark, folder, TRADE, version=2))
    versions.expire_versions(spark, folder)
    assert prices(versions.read_store(spark, folder, TRADE)) == want
    assert prices(versions.read_store(spark, folder, TRADE, version=2)) == pinned == {**{n: float(n) for n in range(4)}, 100: 3.0}
    assert versions.read_store(spark, folder, TRADE).filter(F.col("trade_id") == 100).count() == 1


def test_a_merge_leaves_a_much_larger_base_alone(spark, folder):
    write = versions.upsert_and_merge(folder, TRADE, every=1)
    write(batch_of(spark, range(20_000), 10), 0)
    large = versions.manifest(spark, folder)["base"]
    for n in range(1, 5):
        write(batch_of(spark, [n, 20_000 + n], 10 + n), n)
    state = versions.manifest(spark, folder)
    assert state["below"] == [large] and state["version"] == 5 and state["through"] == 4
    want = {**{i: 10.0 for i in range(20_000)}, **{n: 10.0 + n for n in range(1, 5)}, **{20_000 + n: 10.0 + n for n in range(1, 5)}}
    assert prices(versions.read_store(spark, folder, TRADE)) == want
    versions.expire_versions(spark, folder, keep=1)
    assert sorted(os.listdir(f"{folder}/_base")) == sorted([large, state["base"]])
    assert prices(versions.read_store(spark, folder, TRADE)) == want
    write(batch_of(spark, range(20_000), 90), 5)  # as much again: now they are one
    assert versions.manifest(spark, folder)["below"] == []
    assert prices(versions.read_store(spark, folder, TRADE)) == {**want, **{i: 90.0 for i in range(20_000)}}


def test_merges_rewrite_each_row_a_few_times_only(spark, folder):
    write, written = versions.upsert_and_merge(folder, TRADE, every=1), 0
    for n in range(12):
        write(batch_of(spark, range(2000 * n, 2000 * n + 2000), 10), n)
        written += spark.read.parquet(f"{folder}/_base/{versions.manifest(spark, folder)['base']}").count()
    assert written < 12 * 2000 * 4  # all of it each time would be 6.5 times
    assert versions.read_store(spark, folder, TRADE).count() == 24_000
