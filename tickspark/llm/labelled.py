"""Bounded samples of labelled rows for fitting on the driver."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import held_out, text_of


def label_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int], longest: int, seed: int = 5
) -> pd.DataFrame:
    """Texts and labels (0 or 1) to fit on: at most ``per_class[label]`` rows, texts of at most ``longest`` characters.

    Rows whose id falls into the held-out fifth are never taken. Rows are chosen by a seeded hash of
    the id; an id with several labels counts as 1, null ids and labels are left out. The result is
    the same for any partitioning, and no longer than sum(per_class) * longest characters.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
    )
    hashed = F.xxhash64(F.lit(seed), "doc_id")
    order = Window.partitionBy("label").orderBy(hashed, "doc_id")
    most = F.create_map(*[F.lit(x) for kv in per_class.items() for x in kv])
    # a share of the hashes that leaves some eight times the sample: one task ranks no more than that
    counts = dict(known.groupBy(F.col("label").cast("int")).count().collect())
    share = {k: max(1, counts.get(k, 0) // (8 * n)) for k, n in per_class.items()}
    thinned = F.create_map(*[F.lit(x) for kv in share.items() for x in kv])
    chosen = (
        known.filter(F.pmod(hashed, F.element_at(thinned, F.col("label").cast("int"))) == 0)
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= max(per_class.values()))
        .filter(F.col("place") <= F.element_at(most, F.col("label").cast("int")))
    )
    # at most sum(per_class) rows, by construction small enough to send to every task
    picked = F.broadcast(chosen.select(F.col("doc_id").alias("chosen_id"), "label"))
    rows = (
        docs.select("doc_id", text_of("text").alias("text"))
        .filter(F.length("text") <= longest)
        .join(picked, F.col("doc_id") == F.col("chosen_id"))
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.first("label").alias("label"))
    )
    return rows.toArrow().to_pandas().sort_values("doc_id", ignore_index=True)
