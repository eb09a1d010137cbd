"""Counters of the job that is running anyway: observed metrics in batch, a listener for streams."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..schema import OTHER_PRICE_CAP, PRICE_BOUNDS
from .batch import counter_columns, finish_summary, product_partials
from .quality import is_normal, price_is_sane, with_defaults

NAME = "trade_counters"


def counted_trades(
    trades: DataFrame, observer: Observation | str = NAME, bounds=PRICE_BOUNDS, cap: float = OTHER_PRICE_CAP
) -> DataFrame:
    """Valid trades as ``batch.valid_trades`` has them; all records are counted on their way through.

    ``observer`` is an ``Observation`` for a batch job, or a name under which each micro-batch reports.
    """
    filled = with_defaults(trades)
    sane: Column = price_is_sane(F.col("product"), F.col("price"), bounds, cap)
    seen = filled.observe(observer, *counter_columns(sane))
    return seen.filter(F.coalesce(sane, F.lit(False)) & is_normal())


def observed_summary(trades: DataFrame, bounds=PRICE_BOUNDS, cap: float = OTHER_PRICE_CAP) -> tuple[DataFrame, Observation]:
    """The batch summary, and the counters of the run that computes it (``.get`` after an action)."""
    observer = Observation(NAME)
    return finish_summary(product_partials(counted_trades(trades, observer, bounds, cap))), observer


class CounterLog(StreamingQueryListener):
    """Keeps the counters of each micro-batch as (run, batch, counters); ``ended`` is set when a run has ended.

    A batch reported twice counts once.
    """

    def __init__(self, name: str = NAME):
        self.name, self.rows, self.ended = name, {}, threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(self.name)
        if found is not None:
            self.rows[str(event.progress.id), event.progress.batchId] = found.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()

    def totals(self) -> dict[str, int]:
        names = ("rows_read", "valid_rows", "mapped_rows", "pair_count")
        return {n: sum(row[n] or 0 for row in self.rows.values()) for n in names}
