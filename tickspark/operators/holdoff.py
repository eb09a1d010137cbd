"""Greedy keyed selection: keep an event, ignore what follows within its hold-off, repeat.

The choice depends on everything before it, yet only through one number, the time from which the
next event may be kept. The events of a key are cut into blocks. Each block first reports, for
every time it may be entered with, the time it leaves with (a short step table). Step tables of
neighbouring blocks are joined in a tree; back down the tree each block gets its true entry time,
and all blocks then select in parallel.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .dedup import latest_per_key
from .ordered import running_before, settle

BLOCK_ROWS = 200_000
FAN = 256  # step tables that are joined at a time
NEVER = -(2**62)


def next_positions(us: np.ndarray, hold: np.ndarray) -> np.ndarray:
    """For each event the position of the first one its hold-off does not cover."""
    return np.searchsorted(us, us + hold, side="left")


def exit_times(us: np.ndarray, hold: np.ndarray) -> np.ndarray:
    """For each event, when kept: the time from which the next block may keep one."""
    count = len(us)
    after = next_positions(us, hold)
    last = np.where(after < count, after, np.arange(count))
    while True:
        further = last[last]
        if np.array_equal(further, last):
            return us[last] + hold[last]
        last = further


def kept_positions(us: np.ndarray, hold: np.ndarray, ready: int) -> list[int]:
    """Positions kept by a block entered with the time ``ready``."""
    after = next_positions(us, hold)
    kept = []
    spot = int(np.searchsorted(us, ready, side="left"))
    while spot < len(us):
        kept.append(spot)
        spot = int(after[spot])
    return kept


def _step_table(keys: list[str], longest: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_us", ignore_index=True)
        us, hold = rows["_us"].to_numpy(np.int64), rows["_hold"].to_numpy(np.int64)
        leave = exit_times(us, hold)
        begin = us[0] // longest * longest
        # Earlier holds end within the first bucket, so entry is there or at the event after it.
        entries = min(int(np.searchsorted(us, begin + longest, side="left")) + 1, len(us))
        ends_run = np.r_[leave[1:entries] != leave[: entries - 1], True]
        spots = np.flatnonzero(ends_run)
        out = pd.DataFrame({"upto": us[spots], "leave": leave[spots]})
        for key in [*keys, "_block"]:
            out[key] = rows[key].iloc[0]
        out["begin"] = begin
        return out[[*keys, "_block", "begin", "upto", "leave"]]

    return run


def _pass(tables: list[tuple[np.ndarray, np.ndarray]], ready: int) -> int:
    """The time the last of consecutive blocks leaves with when the first is entered with ``ready``."""
    for upto, leave in tables:
        spot = int(np.searchsorted(upto, ready, side="left"))
        if spot < len(upto):
            ready = int(leave[spot])
    return ready


def _tables(steps: pd.DataFrame, number: str) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    steps = steps.sort_values([number, "upto"], ignore_index=True)
    blocks, first = np.unique(steps[number].to_numpy(), return_index=True)
    upto, leave = steps["upto"].to_numpy(), steps["leave"].to_numpy()
    ends = np.r_[first[1:], len(steps)]
    return blocks, [(upto[i:j], leave[i:j]) for i, j in zip(first, ends)]


def _joined_table(keys: list[str], longest: int):
    """One step table for a run of consecutive blocks; entries lie in the run's first bucket or at the
    event after it, so it is no longer than that of a single block."""

    def run(steps: pd.DataFrame) -> pd.DataFrame:
        _, tables = _tables(steps, "_block")
        bound = int(steps["begin"].min()) + longest
        upto, leave = [], []
        for k, (ends, leaves) in enumerate(tables):
            for end, left in zip(ends, leaves):
                upto.append(int(end))
                leave.append(_pass(tables[k + 1 :], int(left)))
                if end >= bound:
                    break
            if upto[-1] >= bound:
                break
        upto, leave = np.array(upto), np.array(leave)
        spots = np.flatnonzero(np.r_[leave[1:] != leave[:-1], True])
        out = pd.DataFrame({"upto": upto[spots], "leave": leave[spots]})
        for name in [*keys, "_parent"]:
            out[name] = steps[name].iloc[0]
        out["begin"] = steps["begin"].min()
        return out[[*keys, "_parent", "begin", "upto", "leave"]]

    return run


def _entries(keys: list[str]):
    """Entry times of consecutive blocks, from that of the run they form."""

    def run(steps: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        blocks, tables = _tables(steps, "_block")
        ready, entered = int(entry["ready"].iloc[0]), []
        for table in tables:
            entered.append(ready)
            ready = _pass([table], ready)
        out = pd.DataFrame({"_block": blocks, "ready": entered})
        for key in keys:
            out[key] = steps[key].iloc[0]
        return out[[*keys, "_block", "ready"]]

    return run


def _entry_times(steps: DataFrame, keys: list[str], longest: int, fan: int) -> DataFrame:
    """(keys, _block, ready): the time each block is entered with.

    Step tables of ``fan`` consecutive blocks are joined into one, level by level, until a key has one
    run; entry times then go back down the same tree. So no task holds more than ``fan`` tables of a
    key, however many blocks it has.
    """
    fields = {f.name: f for f in steps.schema.fields}
    own = [fields[k] for k in keys]
    longs = lambda *names: T.StructType([*own, *[T.StructField(n, T.LongType()) for n in names]])
    parent = F.floor(F.col("_block") / fan).cast("long")
    levels = [settle(steps.withColumn("_parent", parent), "steps")]
    while levels[-1].filter(F.col("_parent") > 0).limit(1).count():
        joined = levels[-1].groupBy(*keys, "_parent").applyInPandas(
            _joined_table(keys, longest), longs("_parent", "begin", "upto", "leave")
        )
        levels.append(settle(joined.withColumnRenamed("_parent", "_block").withColumn("_parent", parent), "steps"))
    entry = levels[-1].select(*keys, "_parent").distinct().withColumn("ready", F.lit(NEVER))
    for level in reversed(levels):
        runs = level.groupBy(*keys, "_parent").cogroup(entry.groupBy(*keys, "_parent"))
        below = settle(runs.applyInPandas(_entries(keys), longs("_block", "ready")), "entries")
        entry = below.withColumnRenamed("_block", "_parent")
    return below


def _kept_rows(rows: pd.DataFrame, ready: int, keys: list[str]) -> pd.DataFrame:
    rows = rows.sort_values("_us", ignore_index=True)
    us, hold = rows["_us"].to_numpy(np.int64), rows["_hold"].to_numpy(np.int64)
    return rows.iloc[kept_positions(us, hold, ready)][[*keys, "_us", "_tie"]]


def _select_block(keys: list[str]):
    def run(rows: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        return _kept_rows(rows, int(entry["ready"].iloc[0]), keys)

    return run


def greedy_holdoff(
    events: DataFrame,
    keys: list[str],
    at: str,
    tie: str,
    hold_micros: Column,
    longest_micros: int,
    block_rows: int = BLOCK_ROWS,
    fan: int = FAN,
) -> DataFrame:
    """Keep, per key and in time order, each event no kept event before it still holds off.

    ``hold_micros`` is positive and at most ``longest_micros``. Blocks are cut from counts per
    (key, ``longest_micros`` bucket). Of events at one instant only the first by ``tie`` can be
    kept, so the others leave before rows meet in a block, which then has at most ``block_rows``
    rows plus the distinct instants of one bucket. Only key, time, tie and hold-off travel; whole
    rows are looked up for the events kept, by key, time and ``tie``.
    """
    columns = events.columns
    timed = events.filter(F.col(at).isNotNull() & F.col(tie).isNotNull()).withColumns(
        {
            "_us": F.unix_micros(at),
            "_hold": hold_micros.cast("long"),
            "_tie": F.col(tie),
            "_bucket": F.floor(F.unix_micros(at) / F.lit(longest_micros)).cast("long"),
        }
    )
    counts = timed.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = running_before(counts, keys, "_bucket", "_n", "_before")
    cut = settle(
        before.select(*keys, "_bucket", F.floor(F.col("_before") / block_rows).cast("long").alias("_block")),
        "blocks",
    )
    blocked = (
        timed.join(cut, [*keys, "_bucket"])
        .groupBy(*keys, "_block", "_us")
        .agg(F.min("_tie").alias("_tie"), F.min_by("_hold", "_tie").alias("_hold"))
    )

    types = {f.name: f for f in events.schema.fields}
    key_fields = [types[k] for k in keys]
    block = T.StructField("_block", T.LongType())
    steps_type = T.StructType(
        [*key_fields, block, *[T.StructField(n, T.LongType()) for n in ("begin", "upto", "leave")]]
    )
    kept_type = T.StructType(
        [*key_fields, T.StructField("_us", T.LongType()), T.StructField("_tie", types[tie].dataType)]
    )
    groups = blocked.groupBy(*keys, "_block")
    steps = groups.applyInPandas(_step_table(keys, longest_micros), steps_type)
    entry = _entry_times(steps, keys, longest_micros, fan)
    kept = groups.cogroup(entry.groupBy(*keys, "_block")).applyInPandas(_select_block(keys), kept_type)
    found = timed.join(kept, [*keys, "_us", "_tie"])
    rest = [F.struct(*[c for c in columns if c not in keys])]
    return latest_per_key(found, [*keys, "_us"], rest).select(*columns)


def throttle_min_gap(
    trades: DataFrame, seconds: float = 1.0, key: str | None = "product", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Keep a trade only when at least ``seconds`` have passed since the last kept one.

    ``key=None`` throttles all products together, in arrival order.
    """
    hold = round(seconds * 1_000_000)
    columns = trades.columns
    keys = [key] if key else ["_all"]
    rows = trades if key else trades.withColumn("_all", F.lit(0))
    kept = greedy_holdoff(rows, keys, "time", "trade_id", F.lit(hold), hold, block_rows)
    return kept.select(*columns)
