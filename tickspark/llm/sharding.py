"""Sharding by proportional stratified interleaving (DataFrame functions only)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import free_names, same, stored, text_of

ROW_OVERHEAD = 16
LEAST_CELL = 512


def cell_count(rows: int) -> int:
    """Cells to deal ``rows`` rows into: about the square root, so that neither the rows of one cell
    nor the list of all cells grows faster than that."""
    return max(1, math.ceil(rows / max(LEAST_CELL, math.isqrt(rows))))


def interleave(
    rows: DataFrame, shards: int, strata: str = "source", key: tuple[str, ...] = ("doc_id",), seed: int = 7
) -> DataFrame:
    """Deal all rows into shards 0 .. ``shards`` - 1 so that every shard has the mixture of the strata.

    Rows are shuffled by a seeded hash of ``key`` and ranked inside their stratum; all rows are then
    put in the order of the fractional rank (rank + 1/2) / (rows of the stratum) and that sequence is
    cut into ``shards`` runs. Adds ``shard`` and ``slot`` (gapless from 0 in each shard) to ``rows``.
    Shard sizes differ by at most one row, and of any stratum a shard holds its share of the stratum
    to within about one row for each other stratum.

    Ranks are running counts over hash cells plus a row number in the cell, so the largest stratum is
    spread over many tasks. Rows alike in ``key`` are interchangeable. A null stratum is a stratum of
    its own; no rows give no rows. ``rows`` is read several times: store it if it is derived.
    """
    h, cell, size, before, rank, part, frac, place = free_names(
        rows, "hash", "cell", "stratum_rows", "before", "rank", "part", "fraction", "place"
    )
    total = rows.count()
    cells = cell_count(total)
    hashed = rows.withColumn(h, F.xxhash64(F.lit(seed), *key)).withColumn(cell, F.pmod(F.col(h), F.lit(cells)))

    own = Window.partitionBy(strata)
    counts = (
        hashed.groupBy(strata, cell)
        .agg(F.count(F.lit(1)).alias(size))
        .withColumn(before, F.sum(size).over(own.orderBy(cell).rowsBetween(Window.unboundedPreceding, 0)) - F.col(size))
        .withColumn(size, F.sum(size).over(own))
        .alias("c")
    )
    in_cell = Window.partitionBy(strata, cell).orderBy(h, *key)
    ranked = hashed.withColumn(rank, F.row_number().over(in_cell)).alias("r")
    joined = ranked.join(
        counts, same(F.col(f"r.{strata}"), F.col(f"c.{strata}")) & (F.col(f"r.{cell}") == F.col(f"c.{cell}"))
    )
    fraction = (F.col(before) + F.col(rank) - F.lit(0.5)) / F.col(size)
    placed = stored(
        joined.select("r.*", fraction.alias(frac)).withColumn(part, F.floor(F.col(frac) * cells)), "interleave"
    )

    ahead = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, 0)  # one row for each part
    parts = (
        placed.groupBy(part)
        .agg(F.count(F.lit(1)).alias(size))
        .select(part, (F.sum(size).over(ahead) - F.col(size)).alias(before))
    )
    in_part = Window.partitionBy(part).orderBy(frac, strata, h, *key)
    cut = F.lit(shards)
    return (
        placed.withColumn(rank, F.row_number().over(in_part))
        .join(parts, part)
        .withColumn(place, F.col(before) + F.col(rank) - 1)
        .withColumn("shard", F.expr(f"cast({place} * {shards} div {max(total, 1)} as int)"))
        .withColumn("slot", F.col(place) - F.expr(f"(shard * {total}L + {shards - 1}) div {shards}"))
        .drop(h, cell, rank, frac, part, before, place)
    )


def row_columns() -> dict[str, Column]:
    """What stands for a document: id, source, bytes and checksum of the text."""
    text = text_of("text")
    return {
        "doc_id": F.col("doc_id"),
        "source": F.col("source"),
        "size": (F.octet_length(text) + ROW_OVERHEAD).cast("long"),
        "text_crc32": F.crc32(text.cast("binary")),
    }


def document_rows(docs: DataFrame) -> DataFrame:
    """The small row that stands for each document."""
    return docs.select(*[c.alias(n) for n, c in row_columns().items()])


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 7) -> DataFrame:
    """Shards of documents under the law ``rows``: (doc_id, source, size, text_crc32, shard, slot).

    A null text counts as empty; null ids, null sources and repeated rows are dealt out like others.
    """
    rows = stored(document_rows(docs), "shard-rows")
    return interleave(rows, shards, "source", ("doc_id", "text_crc32", "size"), seed)


def write_shards(docs: DataFrame, path: str, shards: int = 40, seed: int = 7) -> None:
    """Write whole documents, one folder ``shard=N`` for each shard.

    Documents meet their shard by id, source, checksum and size; rows alike in all four are copies of each
    other and get the shards of their group one by one. A column ``shard`` of the documents is written as
    ``_shard``, or ``_shard_1`` and so on if that is taken, as the folders have its name.
    """
    keys = ["doc_id", "source", "text_crc32", "size"]
    own = Window.partitionBy(*keys)
    placed = shard_documents(docs, shards, seed)
    places = placed.withColumn("copy", F.row_number().over(own.orderBy("shard", "slot"))).alias("p")
    marked = docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in row_columns().items()])
    numbered = marked.withColumn("copy", F.row_number().over(own.orderBy(F.xxhash64("row")))).alias("d")
    met = [same(F.col(f"d.{c}"), F.col(f"p.{c}")) for c in (*keys, "copy")]
    joined = numbered.join(places, met).select("row", "p.shard", "p.slot")
    (renamed,) = free_names(docs, "shard")
    kept = [F.col(f"row.`{c}`").alias(renamed if c.lower() == "shard" else c) for c in docs.columns]
    (
        joined.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .select(*kept, F.col("shard"))
        .write.partitionBy("shard")
        .parquet(path)
    )
