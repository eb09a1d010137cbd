"""Window summaries: rolling last-n snapshots, sliding time windows, their top trades."""

from __future__ import annotations

from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import (
    LARGEST_REGULAR,
    SMALLEST_REGULAR,
    SUM_SCALE,
    exact_total,
    finite,
    join_parts,
    joined_total,
    odd_total,
    round_half_up,
)
from ..functions.times import clock_label, micros, slot_number, slot_start
from .ordered import running_before, settle, tail_cut
from .quality import usable_for_windows

SNAPSHOT_ROWS = 10_000
SLOT_SECONDS = 10
WINDOW_SECONDS = 60
TOP_TRADES = 5
BLOCK_ROWS = 200_000
LATEST_WINDOWS = 10

_SNAPSHOT = (
    "product string, slot_no bigint, trade_id bigint, us bigint, trade_count bigint,"
    "price_whole bigint, price_fraction bigint, size_whole bigint, size_fraction bigint,"
    "price_odd double, size_odd double,"
    "max_price double, min_price double, buy_count bigint, sell_count bigint,"
    "top_ids array<bigint>, top_times array<bigint>, top_prices array<double>,"
    "top_sizes array<double>, top_sides array<string>"
)


def largest_first(sizes: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` largest values, equal values in arrival order."""
    if len(sizes) > k:
        kth = np.partition(sizes, len(sizes) - k)[len(sizes) - k]
        spots = np.flatnonzero(sizes >= kth)
    else:
        spots = np.arange(len(sizes))
    return spots[np.argsort(-sizes[spots], kind="stable")][:k]


def _snapshot_block(n: int, top_k: int):
    """Summaries at the first trade of each slot of one block; halo rows only fill the frames."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["us", "trade_id"], kind="stable", ignore_index=True)
        slot = rows["slot_no"].to_numpy()
        own = ~rows["halo"].to_numpy(dtype=bool)
        starts = np.r_[True, slot[1:] != slot[:-1]] if len(rows) else np.empty(0, bool)
        at = np.flatnonzero(own & starts)
        begin = np.maximum(at - n + 1, 0)

        def total(values) -> np.ndarray:
            running = np.r_[0, np.cumsum(np.asarray(values, dtype=np.int64))]
            return running[at + 1] - running[begin]

        def decimals(values) -> np.ndarray:
            return np.floor((values - np.floor(values)) * SUM_SCALE + 0.5)

        def split(values) -> tuple[np.ndarray, np.ndarray]:
            """Regular values, and the sums of the others in each frame."""
            far = np.abs(values)
            units = far * SUM_SCALE
            odd = (far >= LARGEST_REGULAR) | ((far < SMALLEST_REGULAR) & (np.abs(units - np.rint(units)) > 1e-9))
            if not odd.any():
                return values, np.zeros(len(at))
            others = np.where(odd, values, 0.0)
            return np.where(odd, 0.0, values), np.array([others[b : e + 1].sum() for b, e in zip(begin, at)])

        price, size = rows["price"].to_numpy(), rows["size"].to_numpy()
        plain_price, odd_price = split(price)
        plain_size, odd_size = split(size)
        side = rows["side"].to_numpy(dtype=object)
        rolling = rows["price"].rolling(n, min_periods=1)
        top = [b + largest_first(size[b : e + 1], top_k) for b, e in zip(begin, at)]
        ids, times = rows["trade_id"].to_numpy(), rows["time_us"].to_numpy()
        return pd.DataFrame(
            {
                "product": rows["product"].to_numpy()[at],
                "slot_no": slot[at],
                "trade_id": ids[at],
                "us": rows["us"].to_numpy()[at],
                "trade_count": at - begin + 1,
                "price_whole": total(np.floor(plain_price)),
                "price_fraction": total(decimals(plain_price)),
                "size_whole": total(np.floor(plain_size)),
                "size_fraction": total(decimals(plain_size)),
                "price_odd": odd_price,
                "size_odd": odd_size,
                "max_price": rolling.max().to_numpy()[at],
                "min_price": rolling.min().to_numpy()[at],
                "buy_count": total(side == "buy"),
                "sell_count": total(side == "sell"),
                "top_ids": pd.Series([ids[t] for t in top], dtype=object),
                "top_times": pd.Series([times[t] for t in top], dtype=object),
                "top_prices": pd.Series([price[t] for t in top], dtype=object),
                "top_sizes": pd.Series([size[t] for t in top], dtype=object),
                "top_sides": pd.Series([list(side[t]) for t in top], dtype=object),
            }
        )

    return run


def _arrivals(trades: DataFrame, slot_seconds: int) -> DataFrame:
    return (
        usable_for_windows(trades)
        .filter(F.col("processed_at").isNotNull())
        .withColumns(
            {
                "slot_no": slot_number("processed_at", slot_seconds),
                "us": micros("processed_at"),
                "time_us": micros("time"),
            }
        )
    )


def _crowded_slot_cuts(rows: DataFrame, crowded: DataFrame, need: int, slot_seconds: int) -> DataFrame:
    """For slots too large for a block: from where on their last ``need`` rows are found."""
    keys = ["product", "slot_no"]
    inside = rows.select(*keys, "us").join(crowded, keys)
    coarse = tail_cut(inside, keys, need, max(1, slot_seconds * 1_000_000 // 4096))
    ends = inside.join(coarse, keys).filter(F.col("us") >= F.col("cut")).drop("cut")
    return tail_cut(ends, keys, need, 1).join(crowded, keys)


def rolling_last_n_snapshot(
    trades: DataFrame,
    n: int = SNAPSHOT_ROWS,
    slot_seconds: int = SLOT_SECONDS,
    label_seconds: int = WINDOW_SECONDS,
    top_k: int = TOP_TRADES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Summary of the last ``n`` trades of a product, at the first trade of every slot.

    Slots are laid end to end per product and cut into blocks of about ``block_rows`` trades; each
    block also receives the slots that reach into the ``n - 1`` trades before it. A slot larger
    than a block contributes its first instant and its last ``n - 1``, all that any summary can use.
    So a task holds a few blocks' worth of rows however the trades spread over products and slots.
    Trades of one product in the same microsecond stay together.
    """
    block_rows = max(block_rows, n)
    keys = ["product", "slot_no"]
    rows = _arrivals(trades, slot_seconds)
    slots = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("us").alias("first_us"))
    slots = settle(running_before(slots, ["product"], "slot_no", "n", "before"), "slots")
    own = F.floor(F.col("before") / block_rows)
    end = F.col("before") + F.col("n")
    feeds = F.array_distinct(F.array(own, F.floor(end / block_rows), F.floor((end + n - 2) / block_rows)))
    targets = slots.select(*keys, own.alias("own"), F.explode(feeds).alias("block"))

    crowded = slots.filter(F.col("n") > block_rows).select(*keys, "first_us")
    cuts = settle(_crowded_slot_cuts(rows, crowded, n - 1, slot_seconds), "cuts")
    rows = (
        rows.join(cuts, keys, "left")
        .filter(F.col("cut").isNull() | (F.col("us") >= F.col("cut")) | (F.col("us") == F.col("first_us")))
        .drop("cut", "first_us")
    )

    blocks = rows.join(targets, keys).select(
        "product",
        "block",
        (F.col("block") != F.col("own")).alias("halo"),
        "slot_no",
        "us",
        "time_us",
        "trade_id",
        "price",
        "size",
        "side",
    )
    found = blocks.groupBy("product", "block").applyInPandas(_snapshot_block(n, top_k), _SNAPSHOT)
    return label_snapshots(found, slot_seconds, label_seconds)


def label_snapshots(found: DataFrame, slot_seconds: int, label_seconds: int) -> DataFrame:
    """Window labels, rounding and nested top trades for raw snapshots.

    The label starts at the slot and ends ``label_seconds`` later, after the data it covers.
    """
    top = F.transform(
        F.arrays_zip("top_ids", "top_times", "top_prices", "top_sizes", "top_sides"),
        lambda t: F.struct(
            t["top_ids"].alias("trade_id"),
            F.timestamp_micros(t["top_times"]).alias("time"),
            F.col("product").alias("product"),
            t["top_prices"].alias("price"),
            t["top_sizes"].alias("size"),
            t["top_sides"].alias("side"),
        ),
    )
    price = join_parts(F.col("price_whole"), F.col("price_fraction")) + F.col("price_odd")
    volume = join_parts(F.col("size_whole"), F.col("size_fraction")) + F.col("size_odd")
    return found.select(
        slot_start("slot_no", slot_seconds).alias("window_start"),
        slot_start("slot_no", slot_seconds, label_seconds).alias("window_end"),
        "product",
        "trade_count",
        round_half_up(price / F.col("trade_count"), 2).alias("avg_price"),
        round_half_up(F.col("max_price"), 2).alias("max_price"),
        round_half_up(F.col("min_price"), 2).alias("min_price"),
        round_half_up(volume, 4).alias("total_volume"),
        "buy_count",
        "sell_count",
        top.alias("top_5_trades"),
        F.timestamp_micros("us").alias("generated_at"),
        F.col("trade_id").alias("emitted_by"),
    )


def slot_first_emission(trades: DataFrame, slot_seconds: int = SLOT_SECONDS) -> DataFrame:
    """The trade that emits the summary of each (product, slot): its first arrival."""
    return (
        _arrivals(trades, slot_seconds)
        .groupBy("product", "slot_no")
        .agg(F.min(F.struct("us", "trade_id")).alias("first"))
        .select(
            "product",
            slot_start("slot_no", slot_seconds).alias("slot_start"),
            F.col("first.trade_id").alias("trade_id"),
            F.timestamp_micros("first.us").alias("emitted_at"),
        )
    )


def window_label(
    trades: DataFrame, slot_seconds: int = SLOT_SECONDS, label_seconds: int = WINDOW_SECONDS
) -> DataFrame:
    """Each non-empty (product, slot) with its window label and number of trades."""
    return (
        _arrivals(trades, slot_seconds)
        .groupBy("product", "slot_no")
        .agg(F.count(F.lit(1)).alias("trades_in_slot"))
        .select(
            "product",
            slot_start("slot_no", slot_seconds).alias("window_start"),
            slot_start("slot_no", slot_seconds, label_seconds).alias("window_end"),
            "trades_in_slot",
        )
    )


def _panes(trades: DataFrame, size: int, slide: int, at: str) -> tuple[DataFrame, int]:
    pane = gcd(size, slide)
    rows = usable_for_windows(trades).filter(F.col(at).isNotNull())
    return rows.withColumn("pane_no", slot_number(at, pane)), pane


def _window_starts(size: int, slide: int, pane: int) -> Column:
    """Starts, in epoch seconds, of the windows that hold a pane."""
    begin = F.col("pane_no") * F.lit(pane)
    last = F.floor(begin / F.lit(slide))
    first = F.ceil((begin + F.lit(pane - size)) / F.lit(slide))
    numbers = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    return F.explode(F.transform(numbers, lambda k: k * F.lit(slide)))


def window_stats() -> list[Column]:
    """Mergeable statistics of one group of trades."""
    return [
        F.count(F.lit(1)).alias("trade_count"),
        exact_total("price").alias("price_total"),
        odd_total("price").alias("price_odd"),
        F.max("price").alias("max_price"),
        F.min("price").alias("min_price"),
        exact_total("size").alias("size_total"),
        odd_total("size").alias("size_odd"),
        F.count_if(F.col("side") == "buy").alias("buy_count"),
        F.count_if(F.col("side") == "sell").alias("sell_count"),
    ]


def finish_windows(stats: DataFrame, start: Column, end: Column) -> DataFrame:
    return stats.select(
        start.alias("window_start"),
        end.alias("window_end"),
        "product",
        "trade_count",
        round_half_up(joined_total("price_total", "price_odd") / F.col("trade_count"), 2).alias("avg_price"),
        round_half_up(F.col("max_price"), 2).alias("max_price"),
        round_half_up(F.col("min_price"), 2).alias("min_price"),
        round_half_up(joined_total("size_total", "size_odd"), 4).alias("total_volume"),
        "buy_count",
        "sell_count",
    )


def panes_of(trades: DataFrame, size: int, slide: int, at: str = "time", also: tuple[str, ...] = ()) -> DataFrame:
    """Mergeable statistics per product and pane, the stretch of time that no window cuts, and per columns ``also``."""
    rows, _ = _panes(trades, size, slide, at)
    return rows.groupBy("product", "pane_no", *also).agg(*window_stats())


def merge_panes(panes: DataFrame, size: int, slide: int, closed_until: Column | None = None) -> DataFrame:
    """Window summaries from panes of any split of the trades.

    A pane leaves out windows that end at or before its ``closed_until``, in microseconds, if that is given.
    """
    spread = panes.withColumn("start", _window_starts(size, slide, gcd(size, slide)))
    if closed_until is not None:
        spread = spread.filter(F.coalesce((F.col("start") + size) * 1_000_000 > closed_until, F.lit(True)))
    merged = spread.groupBy("product", "start").agg(
        F.sum("trade_count").alias("trade_count"),
        F.sum("price_total").alias("price_total"),
        F.sum("price_odd").alias("price_odd"),
        F.max("max_price").alias("max_price"),
        F.min("min_price").alias("min_price"),
        F.sum("size_total").alias("size_total"),
        F.sum("size_odd").alias("size_odd"),
        F.sum("buy_count").alias("buy_count"),
        F.sum("sell_count").alias("sell_count"),
    )
    return finish_windows(
        merged, F.timestamp_seconds("start"), F.timestamp_seconds(F.col("start") + F.lit(size))
    )


def windows_closed_by(trades: DataFrame, size: int, slide: int, until: Column, at: str = "time") -> Column:
    """How many of a trade's windows end at or before ``until`` (microseconds); 0 for a trade no window can use."""
    last = F.floor(F.unix_micros(at) / F.lit(slide * 1_000_000))  # number of the last window with this time
    first = F.floor((F.unix_micros(at) - F.lit(size * 1_000_000)) / F.lit(slide * 1_000_000)) + 1
    ended = F.floor((until - F.lit(size * 1_000_000)) / F.lit(slide * 1_000_000))  # of the last one that is over
    usable = F.coalesce((F.length("product") > 0) & finite("price") & finite("size"), F.lit(False))
    missed = F.greatest(F.lit(0), F.least(last, ended) - first + 1)
    return F.when(usable & until.isNotNull() & F.col(at).isNotNull(), missed).otherwise(0).cast("long")


def sliding_window_summary(
    trades: DataFrame, size: int = WINDOW_SECONDS, slide: int = SLOT_SECONDS, at: str = "time"
) -> DataFrame:
    """Statistics per product and sliding time window.

    Trades are summed into panes first and the panes into windows, so each trade is shuffled at
    most once however many windows overlap it.
    """
    return merge_panes(panes_of(trades, size, slide, at), size, slide)


def top_k_trades_per_window(
    trades: DataFrame,
    k: int = TOP_TRADES,
    size: int = WINDOW_SECONDS,
    slide: int = SLOT_SECONDS,
    at: str = "time",
) -> DataFrame:
    """The ``k`` largest trades of every sliding window, ranked; ties keep arrival order.

    The k largest of each pane come first. That step limits rows before its shuffle, and only its
    survivors are spread over the overlapping windows.
    """
    rows, pane = _panes(trades, size, slide, at)
    order = [F.col("size").desc(), F.col("processed_at"), F.col("trade_id")]
    in_pane = Window.partitionBy("product", "pane_no").orderBy(*order)
    in_window = Window.partitionBy("product", "start").orderBy(*order)
    kept = (
        rows.select("product", "pane_no", "trade_id", "time", "price", "size", "side", "processed_at")
        .withColumn("rank", F.row_number().over(in_pane))
        .filter(F.col("rank") <= k)
        .drop("rank")
    )
    return (
        kept.withColumn("start", _window_starts(size, slide, pane))
        .withColumn("rank", F.row_number().over(in_window))
        .filter(F.col("rank") <= k)
        .select(
            F.timestamp_seconds("start").alias("window_start"),
            "product",
            "rank",
            "trade_id",
            "time",
            "price",
            "size",
            "side",
        )
    )


def with_top_trades(summary: DataFrame, ranked: DataFrame) -> DataFrame:
    """Attach ranked trades as a nested array, at most k per window."""
    keys = ["window_start", "product"]
    nested = ranked.groupBy(*keys).agg(
        F.array_sort(
            F.collect_list(
                F.struct("rank", "trade_id", "time", F.col("product").alias("product_id"), "price", "size", "side")
            )
        ).alias("ranked")
    )
    trades = F.transform(
        "ranked",
        lambda t: F.struct(
            t["trade_id"].alias("trade_id"),
            t["time"].alias("time"),
            t["product_id"].alias("product"),
            t["price"].alias("price"),
            t["size"].alias("size"),
            t["side"].alias("side"),
        ),
    )
    return summary.join(nested, keys, "left").withColumn("top_5_trades", trades).drop("ranked")


def latest_windows(windows: DataFrame, n: int = LATEST_WINDOWS) -> DataFrame:
    """The ``n`` newest windows of every product, newest first as ``recency``."""
    newest = Window.partitionBy("product").orderBy(F.col("window_start").desc())
    return windows.withColumn("recency", F.row_number().over(newest)).filter(F.col("recency") <= n)


def window_history(windows: DataFrame, n: int = LATEST_WINDOWS) -> DataFrame:
    """Chart points of the newest windows, one row each; see :func:`chart_arrays` for the nested form."""
    return latest_windows(windows.filter(F.col("window_start").isNotNull()), n).select(
        "product",
        "recency",
        clock_label("window_start").alias("timestamp"),
        "trade_count",
        "avg_price",
        F.col("total_volume").alias("volume"),
    )


def chart_arrays(points: DataFrame, keys: list[str], order: str, arrays: dict[str, str]) -> DataFrame:
    """Parallel arrays per key, in ``order``, from a bounded number of chart points."""
    gathered = points.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(order, *[c for c in arrays.values() if c != order]))).alias("_points")
    )
    return gathered.select(
        *keys, *[F.col("_points").getField(c).alias(name) for name, c in arrays.items()]
    )
