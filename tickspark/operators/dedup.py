"""Set operations: appending pages, collapsing rewrites of one key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F


def union_pages(*pages: DataFrame) -> DataFrame:
    """Append collections by column name; a column one page lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def latest_per_key(rows: DataFrame, keys, order) -> DataFrame:
    """The last write per key.

    Spark limits every group to one row before the shuffle, so a key that holds a large share of
    all rows ships one row per map task.
    """
    newest = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def dedup_by_trade_id(trades: DataFrame, key=("product", "trade_id")) -> DataFrame:
    """One row per trade, the latest ``processed_at`` winning.

    Ids are unique per product, so the product is part of the key; pass ``key=("trade_id",)`` for
    stores keyed by the id alone. Remaining columns only break exact ties.
    """
    ties = [c for c in ("time", "product", "price", "size", "side") if c in trades.columns and c not in key]
    order = [F.col("processed_at").desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in ties]
    return latest_per_key(trades, key, order)
