"""Keyed stateful stream operators.

State is kept per key and is small and bounded: a time, a slot, or at most n trades. Rows of one
key in one micro-batch go to one task, so a source should bound its micro-batches
(``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``); over stored data use the batch operators,
which split busy keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.fleet import AlertRule, event_rows
from ..operators.holdoff import NEVER, kept_positions
from ..operators.windows import (
    _SNAPSHOT,
    SLOT_SECONDS,
    SNAPSHOT_ROWS,
    TOP_TRADES,
    WINDOW_SECONDS,
    _arrivals,
    _snapshot_block,
    label_snapshots,
)
from .feeds import with_clock


def _gather(parts: Iterator[pd.DataFrame]) -> pd.DataFrame:
    frames = [p for p in parts if len(p)]
    return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame()


class MinGap(StatefulProcessor):
    """Keep a row only when the hold-off of the last kept one is over."""

    def __init__(self, hold_micros: int):
        self.hold = hold_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ready = handle.getValueState("ready", "ready long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = _gather(rows)
        if not len(batch):
            return
        batch = batch.sort_values(["us", "trade_id"], kind="stable", ignore_index=True)
        us = batch["us"].to_numpy(np.int64)
        ready = self.ready.get()[0] if self.ready.exists() else NEVER
        kept = kept_positions(us, np.full(len(us), self.hold), ready)
        if kept:
            self.ready.update((int(us[kept[-1]] + self.hold),))
            yield batch.iloc[kept].drop(columns=["us"])

    def close(self) -> None:
        pass


def stream_throttle(trades: DataFrame, seconds: float = 1.0, key: str = "product") -> DataFrame:
    """Streaming form of ``throttle_min_gap`` per key; ``batches.put_throttled`` has one clock for all."""
    hold = round(seconds * 1_000_000)
    rows = trades.filter(F.col("time").isNotNull()).withColumn("us", F.unix_micros("time"))
    return rows.groupBy(key).transformWithStateInPandas(
        MinGap(hold), trades.schema, outputMode="Append", timeMode="None"
    )


_TAIL = "us long, time_us long, trade_id long, slot_no long, price double, size double, side string"
_TAIL_COLUMNS = [part.strip().split()[0] for part in _TAIL.split(",")]


_CHUNK = "rows long, " + ", ".join(
    f"{n} array<{t}>" for n, t in (part.strip().split() for part in _TAIL.split(","))
)


class LastN(StatefulProcessor):
    """Last-n snapshots: the previous n - 1 trades and the last slot that emitted.

    Trades are kept in chunks, one for what each micro-batch brought. A batch writes its own chunk and
    removes those that n - 1 later trades have pushed out, so writes follow the batch and not n. With
    ``idle`` (seconds of event time) a timer forgets a product that has had no trade for so long.
    """

    def __init__(self, n: int, top_k: int, idle: float | None = None):
        self.n, self.top_k, self.idle = n, top_k, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("chunks", "chunk long", _CHUNK)
        self.mark = handle.getValueState("mark", "first long, next long, slot long, timer long")

    def _before(self, first: int, following: int) -> tuple[pd.DataFrame, list[int]]:
        frames, sizes = [], []
        for number in range(first, following):
            rows, *columns = self.chunks.getValue((number,))
            sizes.append(int(rows))
            frames.append(pd.DataFrame(dict(zip(_TAIL_COLUMNS, map(list, columns)))))
        return (pd.concat(frames, ignore_index=True) if frames else pd.DataFrame()), sizes

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = _gather(rows)
        if not len(batch):
            return
        product = key[0]
        first, following, last, timer = self.mark.get() if self.mark.exists() else (0, 0, NEVER, 0)
        before, sizes = self._before(first, following)
        batch = batch.sort_values(["us", "trade_id"], kind="stable", ignore_index=True)
        before["halo"] = True
        batch["halo"] = False
        both = pd.concat([before, batch], ignore_index=True) if len(before) else batch
        both["product"] = product
        found = _snapshot_block(self.n, self.top_k)(both)
        found = found[found["slot_no"] > last]
        keep = batch.tail(self.n - 1)[_TAIL_COLUMNS] if self.n > 1 else batch.head(0)
        if len(keep):
            self.chunks.updateValue((following,), (len(keep), *[keep[c].tolist() for c in _TAIL_COLUMNS]))
            sizes.append(len(keep))
            following += 1
        held = sum(sizes)
        while sizes and held - sizes[0] >= self.n - 1:
            held -= sizes.pop(0)
            self.chunks.removeKey((first,))
            first += 1
        if self.idle is not None:
            if timer:
                self.handle.deleteTimer(timer)
            timer = max(int(batch["time_us"].max()) // 1000, timerValues.getCurrentWatermarkInMs()) + round(self.idle * 1000)
            self.handle.registerTimer(timer)
        self.mark.update((int(first), int(following), int(max(last, both["slot_no"].max())), int(timer)))
        if len(found):
            yield found

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        first, following, slot, timer = self.mark.get() if self.mark.exists() else (0, 0, NEVER, 0)
        if timer and timer <= timerValues.getCurrentWatermarkInMs():
            for number in range(first, following):
                self.chunks.removeKey((number,))
            self.mark.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_rolling_last_n(
    trades: DataFrame,
    n: int = SNAPSHOT_ROWS,
    slot_seconds: int = SLOT_SECONDS,
    label_seconds: int = WINDOW_SECONDS,
    top_k: int = TOP_TRADES,
    idle_seconds: float | None = None,
    delay: str = "10 minutes",
    marks: DataFrame | None = None,
) -> DataFrame:
    """Streaming form of ``rolling_last_n_snapshot``; slots already emitted stay as they are.

    State is the last trades of each product. With ``idle_seconds`` that of a product without a trade for so
    long is dropped once the watermark, ``delay`` behind the newest trade, has seen it; it starts afresh.
    """
    usable = _arrivals(trades, slot_seconds)
    columns = ["product", *_TAIL_COLUMNS]
    if idle_seconds is None:
        rows, mode = usable.select(*columns), "None"
    else:
        timed = with_clock(usable.filter(F.col("time").isNotNull()).select(*columns, "time"), delay, marks)
        rows, mode = timed, "EventTime"
    found = rows.groupBy("product").transformWithStateInPandas(
        LastN(n, top_k, idle_seconds), T._parse_datatype_string(_SNAPSHOT), outputMode="Append", timeMode=mode
    )
    return label_snapshots(found, slot_seconds, label_seconds)


class Hysteresis(StatefulProcessor):
    """Threshold alerts: start of the low run, and the time before which no action may follow."""

    def __init__(self, rule: AlertRule):
        self.rule = rule

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("alert", "low_since long, ready long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch, rule = _gather(rows), self.rule
        if not len(batch):
            return
        batch = batch.sort_values("us", kind="stable", ignore_index=True)
        low_since, ready = self.state.get() if self.state.exists() else (NEVER, NEVER)
        spots, actions = [], []
        for spot, (us, low, up) in enumerate(zip(batch["us"], batch["low"], batch["up"])):
            if not low:
                low_since = NEVER
            elif low_since == NEVER:
                low_since = us
            down = low and us - low_since > rule.hold * 1_000_000
            if (up or down) and us >= ready:
                delay = rule.up_delay if up else rule.down_delay
                ready = us + round((rule.cooldown + delay) * 1_000_000) + 1
                spots.append(spot)
                actions.append("scale_up" if up else "scale_down")
        self.state.update((int(low_since), int(ready)))
        if spots:
            yield batch.iloc[spots][["fleet", "ts", "level", "cpu"]].assign(action=actions)

    def close(self) -> None:
        pass


def stream_alerts(ticks: DataFrame, rule: AlertRule = AlertRule()) -> DataFrame:
    """Streaming form of ``hysteresis_alerts``. A tick without level or reading is neither low nor high."""
    low = (F.col("level") > rule.min_level) & (F.col("cpu") < rule.low)
    up = (F.col("level") < rule.max_level) & (F.col("cpu") > rule.high)
    rows = ticks.select("fleet", "ts", "level", "cpu").withColumns(
        {"us": F.unix_micros("ts"), "low": F.coalesce(low, F.lit(False)), "up": F.coalesce(up, F.lit(False))}
    )
    acted = rows.groupBy("fleet").transformWithStateInPandas(
        Hysteresis(rule),
        T._parse_datatype_string("fleet string, ts timestamp, level int, cpu double, action string"),
        outputMode="Append",
        timeMode="None",
    )
    return event_rows(acted, rule)
