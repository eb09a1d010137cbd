"""Mixing sources to target weights with pivotal dependent rounding over a reduction tree."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import BLANK, same, stored, text_of

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
CELL_ROWS = 2048


def source_targets(
    sizes: DataFrame, source: str = "source", size: str = "size", weights: Sequence[float] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """Per source (source, source_size, target), from rows of (source, size).

    Sources in code point order, null last, get the weights in turn. Targets share the sum of all
    sizes by weight; a target stops at ``most`` times its source's size, and what it gives up is
    shared again by weight among the others until none is above. Only one row for each source is
    ever held; each round brings two sums to the driver.
    """
    totals = sizes.groupBy(source).agg(F.sum(size).cast("long").alias("source_size"))
    order = Window.orderBy(F.col(source).isNull(), F.col(source).cast("binary"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    table = stored(
        totals.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int") + 1)),
        "sources",
    )
    limit = F.col("source_size") * float(most)
    total = table.agg(F.sum("source_size")).first()[0] or 0
    rate, capped_rows = 0.0, -1
    while total:
        capped = F.col("weight") * rate > limit
        left, share, now = table.agg(
            F.sum(F.when(capped, limit).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))), F.count_if(capped)
        ).first()
        if now == capped_rows or not share:
            break
        rate, capped_rows = (total - left) / share, now
    return table.select(source, "source_size", F.least(F.col("weight") * rate, limit).alias("target"))


def pivot(sizes: np.ndarray, parts: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Round copy probabilities so that at most one stays fractional and sum(sizes * parts) is kept.

    Goes through the rows once, holding one fractional row. It and the next one exchange words until
    one of them is at 0 or 1; the direction is drawn so that each expected probability stays as is.
    """
    out = parts.copy()
    held = -1
    for i in range(len(out)):
        if not 0.0 < out[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b = held, i
        up = min((1.0 - out[a]) * sizes[a], out[b] * sizes[b])  # words that a can take from b
        down = min(out[a] * sizes[a], (1.0 - out[b]) * sizes[b])
        moved = up if draws[i] * (up + down) < down else -down
        out[a] += moved / sizes[a]
        out[b] -= moved / sizes[b]
        for k in (a, b):
            if out[k] < 1e-9:
                out[k] = 0.0
            elif out[k] > 1.0 - 1e-9:
                out[k] = 1.0
        held = a if 0.0 < out[a] < 1.0 else b if 0.0 < out[b] < 1.0 else -1
    return out


def _pivot_cell(rows: pd.DataFrame) -> pd.DataFrame:
    # large ones first, so that what stays fractional in the end is small
    rows = rows.sort_values(["_size", "_hash", "_row"], ascending=[False, True, True], kind="stable", ignore_index=True)
    draws = (rows["_draw"].to_numpy(dtype=np.int64) & ((1 << 53) - 1)) / float(1 << 53)
    rows["_part"] = pivot(rows["_size"].to_numpy(dtype=float), rows["_part"].to_numpy(dtype=float), draws)
    return rows


def round_copies(rows: DataFrame, seed: int = 11, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Whole copies for rows of (_row, _stratum, _size, _part, _hash): (_row, _copies).

    ``_part`` is the fractional number of copies, ``_hash`` a seeded hash of the row's content. Cells
    of about ``cell_rows`` rows are rounded on their own, each leaving one fractional row at most;
    these residuals form cells of the next level, until each stratum is one cell. The last row of a
    stratum is drawn. So a stratum's words miss its target by less than one row, a stratum of any
    size is spread over its cells, and the draws depend on content alone, so reruns agree. Rows
    without words get no copies. Each level is stored; the next starts from its files.
    """
    shape = "_row long, _stratum string, _size long, _part double, _hash long, _whole long"
    level, done = 0, []
    live = rows.withColumn("_whole", F.floor("_part").cast("long")).withColumn("_part", F.col("_part") - F.floor("_part"))
    live = live.withColumn("_part", F.when(F.col("_size") > 0, F.col("_part")).otherwise(0.0))
    live = live.select(*[c.split()[0] for c in shape.split(", ")])
    live = stored(live, "mix-0")
    while True:
        most = (
            live.filter("_part > 0").groupBy("_stratum").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        ) or 0
        done.append(live.filter("_part <= 0"))
        if most == 0:
            break
        if most == 1:
            drawn = F.pmod(F.xxhash64(F.lit(seed), F.lit(-1), "_hash"), F.lit(1 << 30)) / float(1 << 30)
            last = live.filter("_part > 0")
            done.append(last.withColumn("_part", F.when(drawn < F.col("_part"), 1.0).otherwise(0.0)))
            break
        level += 1
        cells = math.ceil(most / cell_rows)
        dealt = (
            live.filter("_part > 0")
            .withColumn("_draw", F.xxhash64(F.lit(seed), F.lit(level), "_hash"))
            .withColumn("_cell", F.pmod(F.xxhash64(F.lit(seed), F.lit(level), F.lit(0), "_hash"), F.lit(cells)))
        )
        rounded = dealt.groupBy("_stratum", "_cell").applyInPandas(_pivot_cell, dealt.schema)
        # what a cell settled as whole copies leaves the tree here
        rounded = rounded.withColumn("_whole", F.col("_whole") + F.floor("_part").cast("long")).withColumn(
            "_part", F.col("_part") - F.floor("_part")
        )
        live = stored(rounded.select(*[c.split()[0] for c in shape.split(", ")]), f"mix-{level}")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("_row", (F.col("_whole") + F.floor("_part").cast("long")).alias("_copies"))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{BLANK}]+")).cast("long")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = 11,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Copies of each document in a mix: (doc_id, mark, source, size, source_size, target, copies).

    A document of a source with target t and size s is wanted t / s times; whole copies are given,
    the fraction is rounded by ``round_copies``. Null texts have size 0 and no copies; a null source
    is a source; repeated rows are documents of their own; no rows give no rows. ``copies`` never
    exceeds ``most``. ``mark`` is a hash of the text.
    """
    # texts are read here and nowhere else
    slim = docs.select(
        "doc_id",
        F.xxhash64("text").alias("mark"),
        "source",
        word_count(text_of("text")).alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("hash"),
    )
    base = stored(slim.withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    targets = stored(source_targets(base, "source", "size", weights, most), "mix-targets").alias("t")
    wanted = (
        base.alias("b")
        .join(targets, same(F.col("b.source"), F.col("t.source")))
        .filter("b.size > 0")
        .select(
            F.col("b.row").alias("_row"),
            # one letter ahead tells the null source from every other
            F.concat(F.when(F.col("b.source").isNull(), "n").otherwise("s"), F.coalesce("b.source", F.lit(""))).alias("_stratum"),
            F.col("b.size").alias("_size"),
            (F.col("target") / F.col("source_size")).alias("_part"),
            F.col("b.hash").alias("_hash"),
        )
    )
    copies = round_copies(wanted, seed, cell_rows)
    return (
        base.alias("b")
        .join(copies, F.col("b.row") == F.col("_row"), "left")
        .join(targets, same(F.col("b.source"), F.col("t.source")))
        .select("b.doc_id", "b.mark", "b.source", "b.size", "t.source_size", "t.target", F.coalesce("_copies", F.lit(0)).alias("copies"))
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, each document as often as the mix takes it.

    Documents meet their copies by id, source and hash of the text; rows alike in all three, which are copies
    of each other and have the same target, take their numbers one by one.
    """
    own = Window.partitionBy("doc_id", "mark", "source")
    taken = mix(docs, **options).withColumn("nth", F.row_number().over(own.orderBy(F.col("copies").desc()))).filter("copies > 0")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("mark"), "source")
    numbered = rows.withColumn("nth", F.row_number().over(own.orderBy(F.xxhash64("row")))).alias("d")
    met = [same(F.col(f"d.{c}"), F.col(f"t.{c}")) for c in ("doc_id", "mark", "source", "nth")]
    return (
        numbered.join(taken.alias("t"), met)
        .select(F.explode(F.array_repeat("d.row", F.col("t.copies").cast("int"))).alias("k"))
        .select("k.*")
    )
