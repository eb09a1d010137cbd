"""Batches of a stream that close at a number of rows or after a time, whichever comes first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .feeds import FLUSH_ROWS, with_clock

FLUSH_SECONDS = 60
BY_COUNT, BY_TIME = "count", "time"
PIECE_ROWS = 10_000  # rows handed out at a time


def cut_batches(us: np.ndarray, rows: int, micros: int) -> tuple[list[tuple[int, int, str]], int]:
    """([start, end), reason of the batches that are closed, start of the one still open).

    ``us`` are times in order of arrival. A batch closes with its ``rows``-th row, or before the first row
    at least ``micros`` later than the row that opened it.
    """
    done, start = [], 0
    while start < len(us):
        later = np.flatnonzero(us[start : start + rows] >= us[start] + micros)
        if len(later):
            done.append((start, start + int(later[0]), BY_TIME))
        elif start + rows <= len(us):
            done.append((start, start + rows, BY_COUNT))
        else:
            break
        start = done[-1][1]
    return done, start


class CountOrTime(StatefulProcessor):
    """Holds the open batch of a key, fewer than ``rows`` rows; a timer closes it when no row does."""

    def __init__(self, schema: StructType, rows: int, seconds: float):
        self.schema, self.rows, self.millis = schema, rows, round(seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", self.schema)
        self.open = handle.getValueState("open", "number long, held long, timer long")

    def _frame(self, held) -> pd.DataFrame:
        return pd.DataFrame([tuple(r) for r in held], columns=self.schema.names)

    def _out(self, frame: pd.DataFrame, number: int, reason: str) -> pd.DataFrame:
        return frame.assign(flush=number, reason=reason)[[*self.schema.names, "flush", "reason"]]

    def _closed(self, frame: pd.DataFrame, number: int, done: list[tuple[int, int, str]]) -> Iterator[pd.DataFrame]:
        """Closed batches, which lie end to end in ``frame``, in pieces that don't depend on the batches' size."""
        sizes = [last - first for first, last, _ in done]
        flushes = np.repeat(np.arange(number, number + len(done), dtype=np.int64), sizes)
        reasons = np.repeat(np.array([reason for *_, reason in done], dtype=object), sizes)
        for at in range(0, len(frame), PIECE_ROWS):
            piece = slice(at, at + PIECE_ROWS)
            yield frame.iloc[piece].assign(flush=flushes[piece], reason=reasons[piece])[[*self.schema.names, "flush", "reason"]]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat([p[self.schema.names] for p in rows], ignore_index=True)
        if not len(new):
            return
        new = new.sort_values(["time", "trade_id"], kind="stable", ignore_index=True)
        number, held, timer = self.open.get() if self.open.exists() else (0, 0, 0)
        both = pd.concat([self._frame(self.held.get()), new], ignore_index=True) if held else new
        us = both["time"].astype("datetime64[us]").to_numpy().astype(np.int64)
        done, start = cut_batches(us, self.rows, self.millis * 1000)
        yield from self._closed(both.iloc[:start], number, done)
        number += len(done)
        rest = both.iloc[start:]
        if not done:
            # still the same batch: only the new rows are written
            self.held.appendList([tuple(r) for r in new.itertuples(index=False, name=None)])
        elif len(rest):
            self.held.put([tuple(r) for r in rest.itertuples(index=False, name=None)])
        else:
            self.held.clear()
        if timer and (done or not len(rest)):
            self.handle.deleteTimer(timer)
            timer = 0
        if len(rest) and not timer:
            timer = int(us[start]) // 1000 + self.millis
            self.handle.registerTimer(timer)
        self.open.update((int(number), len(rest), timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number, held, timer = self.open.get() if self.open.exists() else (0, 0, 0)
        if held and timer <= timerValues.getCurrentWatermarkInMs():
            yield self._out(self._frame(self.held.get()), number, BY_TIME)
            self.held.clear()
            self.open.update((int(number) + 1, 0, 0))

    def close(self) -> None:
        pass


def flush_count_or_time(
    trades: DataFrame,
    rows: int = FLUSH_ROWS,
    seconds: float = FLUSH_SECONDS,
    key: str = "product",
    delay: str = "10 minutes",
    marks: DataFrame | None = None,
) -> DataFrame:
    """The trades of a stream with the batch they are written in: ``flush`` (from 0 per key) and its ``reason``.

    A batch closes with its ``rows``-th trade, or once ``seconds`` of event time have passed since its first
    one: seen from a later trade, or from the watermark when none follows. Trades without key or time are
    left out, those later than ``delay`` too. State is the open batch of each key.
    """
    schema = StructType([StructField(f.name, f.dataType) for f in trades.schema.fields])
    timed = with_clock(trades.filter(F.col(key).isNotNull() & F.col("time").isNotNull()), delay, marks, key)
    out = StructType([*schema.fields, StructField("flush", LongType()), StructField("reason", StringType())])
    return timed.groupBy(key).transformWithStateInPandas(
        CountOrTime(schema, rows, seconds), out, outputMode="Append", timeMode="EventTime"
    )
