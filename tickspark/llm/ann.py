"""Approximate nearest neighbours: multiprobe p-stable hashing with exact reranking."""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import sorted_runs, stored

CELLS = 4  # cells are cut off at this many from the middle, so that there are few buckets to count
RATIO = 1.25  # norms within one level differ by no more than this
CROWDED = 16  # a level with at least this part of all members is hashed, a smaller one is compared as it is
POOL_BYTES = 1 << 22  # of each of the two pools that queries are measured against first


@dataclass(frozen=True)
class Settings:
    """``tables`` of ``hashes`` projections each, cells ``width`` wide (longest vector of the level = 1).

    A query visits as many buckets of each table as give a neighbour the estimated chance ``sure`` of being
    met in one of them, neighbours being at most as far as what the pools have shown; ``likely`` sets that
    distance to a fixed one instead.
    """

    tables: int = 8
    hashes: int = 4
    width: float = 1.5
    sure: float = 0.95
    likely: float | None = None
    block_members: int = 4096
    block_queries: int = 1024
    pool: int = 2048
    seed: int = 3

    @property
    def buckets(self) -> int:
        return (2 * CELLS + 1) ** self.hashes


class Hashes:
    """Gaussian projections of vectors that get one more component, with which the largest inner
    product is the smallest distance: members (x / longest, rest), queries (q / |q|, 0)."""

    def __init__(self, s: Settings, dim: int):
        rng = np.random.default_rng(s.seed)
        self.s = s
        self.lines = rng.normal(size=(s.tables, s.hashes, dim + 1))
        self.shift = rng.uniform(0, s.width, (s.tables, s.hashes))
        self.place = (2 * CELLS + 1) ** np.arange(s.hashes, dtype=np.int64)
        self.moves = np.array(list(itertools.product((-2, -1, 0, 1, 2), repeat=s.hashes)), dtype=np.int64)

    def spots(self, x: np.ndarray) -> np.ndarray:
        """Position of each vector on each line, in cells: (rows, tables, hashes)."""
        return (np.einsum("nd,thd->nth", x, self.lines) + self.shift) / self.s.width

    def code(self, cells: np.ndarray) -> np.ndarray:
        return ((np.clip(cells, -CELLS, CELLS) + CELLS) * self.place).sum(axis=-1)

    def members(self, x: np.ndarray, longest: np.ndarray) -> np.ndarray:
        """Bucket of each vector in each table; ``longest`` is that of each vector's level."""
        x = x / longest[:, None]
        rest = np.sqrt(np.maximum(0.0, 1.0 - (x**2).sum(axis=1)))
        return self.code(np.floor(self.spots(np.column_stack([x, rest]))).astype(np.int64))

    def probes(self, q: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """((rows, tables, moves) buckets, how many of them to visit in each table), best ones first.

        The order is that of the chance that a neighbour at distance ``far`` fell there: its projection
        is normal around the query's, so that a move's chances multiply. Enough are visited when the
        chance of missing it in all tables is at most 1 - ``sure``.
        """
        q = q / np.sqrt((q**2).sum(axis=1, keepdims=True))
        spot = self.spots(np.column_stack([q, np.zeros(len(q))]))
        cell = np.floor(spot)
        steps = np.arange(-2, 4)
        scale = self.s.width / np.maximum(far, 1e-3) / math.sqrt(2)
        edge = (cell[..., None] + steps - spot[..., None]) * scale[:, None, None, None]
        below = 0.5 * (1.0 + np.vectorize(math.erf, otypes=[float])(edge))
        odds = np.maximum(np.diff(below, axis=-1), 1e-12)  # (rows, tables, hashes, moves -2..2)
        chance = np.ones((*odds.shape[:2], len(self.moves)))
        for j in range(self.s.hashes):
            chance *= odds[:, :, j, self.moves[:, j] + 2]
        best = np.argsort(-chance, axis=-1, kind="stable")
        met = np.minimum(np.cumsum(np.take_along_axis(chance, best, axis=-1), axis=-1), 1.0)
        missed = np.prod(1.0 - met, axis=1)  # in all tables, after so many probes in each
        count = np.minimum((missed > 1.0 - self.s.sure).sum(axis=1) + 1, len(self.moves))
        return self.code(cell[:, :, None, :].astype(np.int64) + self.moves[best]), count


@dataclass(frozen=True)
class Levels:
    """Members by length: ``hashed`` and ``plain`` levels with the longest norm of each, (number, norm)."""

    hashed: tuple[tuple[int, float], ...]
    plain: tuple[tuple[int, float], ...]
    pool: np.ndarray
    pool_ids: np.ndarray
    k: int

    def sure_score(self, ids: np.ndarray, q: np.ndarray) -> np.ndarray:
        """For each query a score that at least k members other than itself reach."""
        if len(self.pool) <= self.k:
            return np.full(len(q), -np.inf)
        score = q @ self.pool.T
        score[ids[:, None] == self.pool_ids[None, :]] = -np.inf
        return np.partition(score, len(self.pool) - self.k, axis=1)[:, len(self.pool) - self.k]


def _matrix(column) -> np.ndarray:
    """Vectors of an Arrow list column as doubles, one for each row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _cells(s: Settings, hashes: Hashes, levels: Levels, ids: np.ndarray, x: np.ndarray, level: np.ndarray | None):
    """(row, cell) of all cells that members belong to, or that queries (without ``level``) visit.

    A hashed level has tables * buckets cells, a plain one has one, numbered after those.
    """
    size = s.tables * s.buckets
    first_plain = len(levels.hashed) * size
    tables = np.arange(s.tables) * s.buckets
    rows, cells = [], []
    if level is not None:
        for at, (number, longest) in enumerate(levels.hashed):
            own = np.flatnonzero(level == number)
            if len(own):
                found = hashes.members(x[own], np.full(len(own), longest)) + tables + at * size
                rows.append(np.repeat(own, s.tables))
                cells.append(found.ravel())
        for at, (number, _) in enumerate(levels.plain):
            own = np.flatnonzero(level == number)
            rows.append(own)
            cells.append(np.full(len(own), first_plain + at))
    else:
        norm = np.sqrt((x**2).sum(axis=1))
        score = levels.sure_score(ids, x)
        for at, (_, longest) in enumerate(levels.hashed):
            most = longest * norm
            for i in range(0, len(x), 128):
                own = i + np.flatnonzero(most[i : i + 128] * (1 + 1e-9) >= score[i : i + 128])  # no member of the others comes near
                if not len(own):
                    continue
                near = np.clip(score[own] / most[own], -1.0, 1.0)
                far = np.sqrt(2 - 2 * near) if s.likely is None else np.full(len(own), s.likely)
                found, count = hashes.probes(x[own], far)
                inside = np.broadcast_to(np.arange(found.shape[2]) < count[:, None, None], found.shape)
                rows.append(np.repeat(own, count * s.tables))
                cells.append((found + tables[None, :, None] + at * size)[inside])
        for at, (_, longest) in enumerate(levels.plain):
            own = np.flatnonzero(longest * norm * (1 + 1e-9) >= score)
            rows.append(own)
            cells.append(np.full(len(own), first_plain + at))
    pair = np.column_stack([np.concatenate(rows), np.concatenate(cells)]) if rows else np.empty((0, 2), dtype=np.int64)
    if level is None:  # several moves can end in one cell that is cut off
        pair = np.unique(pair, axis=0)
    return pair[:, 0], pair[:, 1]


def _placed(rows: DataFrame, hashes: Hashes, levels: Levels, members: int, queries: int, per_cell: dict | None, query: bool) -> DataFrame:
    """Rows (cell, block, kind, id, vector): each vector in the cells it belongs to or visits.

    ``per_cell`` has (members, queries) of the cells; blocks of both kinds are paired inside a cell,
    so no task holds more than one block of each, however full the cell is.
    """
    s, kind = hashes.s, dict(rows.dtypes)["vector"]

    def run(batches):
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            vectors = b.column(1)
            level = None if query else b.column(2).to_numpy(zero_copy_only=False)
            row, cell = _cells(s, hashes, levels, ids, _matrix(vectors), level)
            block = np.zeros(len(cell), dtype=np.int64)
            if per_cell is not None:
                counts = np.array([per_cell.get(c, (0, 0)) for c in cell.tolist()]).reshape(-1, 2)
                mine = -(-np.maximum(counts[:, 1 if query else 0], 1) // (queries if query else members))
                others = -(-counts[:, 0 if query else 1] // (members if query else queries))
                spread = (ids[row].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
                own = spread % mine
                again = np.repeat(np.arange(len(row)), others)
                place = np.arange(len(again)) - np.repeat(np.cumsum(others) - others, others)
                row, cell = row[again], cell[again]
                block = (place * 1_000_000 + own[again]) if query else (own[again] * 1_000_000 + place)
            for i in range(0, len(row), 4096):
                at = row[i : i + 4096]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cell[i : i + 4096], pa.int64()),
                        pa.array(block[i : i + 4096], pa.int64()),
                        pa.array(np.full(len(at), int(query), dtype=np.int32)),
                        pa.array(ids[at], pa.int64()),
                        vectors.take(pa.array(at)) if per_cell is not None else pa.array([[]] * len(at), vectors.type),
                    ],
                    ["cell", "block", "kind", "id", "vector"],
                )

    slim = rows.select("id", "vector") if query else rows.select("id", "vector", "level")
    return slim.mapInArrow(run, f"cell long, block long, kind int, id long, vector {kind}")


def best_of(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int):
    """For each query its k largest inner products with x: (ids, scores), ties to smaller ids.

    A matrix product preselects; what may be among the best is computed again as a plain sum, which
    gives equal vectors equal scores.
    """
    rough = q @ x.T
    k = min(k, len(ids))
    edge = np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k]
    slack = 1e-9 * (np.abs(edge) + np.abs(rough).max(axis=1))
    for i in range(len(q)):
        near = np.flatnonzero(rough[i] >= edge[i] - slack[i])
        score = (x[near] * q[i]).sum(axis=1)
        order = np.lexsort((ids[near], -score))[:k]
        yield ids[near][order], score[order]


def _ranked(placed: DataFrame, k: int) -> DataFrame:
    """(id, found array<struct<far, vec_id>>): per query the k best of all its cells."""

    def run(batches):
        for _, t in sorted_runs(batches, ["cell", "block"]):
            kind = t.column("kind").to_numpy()
            cut = int(np.searchsorted(kind, 1))
            if cut == 0 or cut == len(kind):
                continue
            ids, x = t.column("id").to_numpy(), _matrix(t.column("vector"))
            near, scores = zip(*best_of(x[cut:], x[:cut], ids[:cut], k))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[cut:], pa.int64()),
                    pa.array([-v for v in scores], pa.list_(pa.float64())),
                    pa.array(list(near), pa.list_(pa.int64())),
                ],
                ["id", "far", "near"],
            )

    parts = (
        placed.repartition("cell", "block")
        .sortWithinPartitions("cell", "block", "kind")
        .mapInArrow(run, "id long, far array<double>, near array<long>")
    )
    # per query at most tables * probes lists of k, so these groups are small whatever the corpus
    zipped = F.arrays_zip(F.col("far"), F.col("near").alias("vec_id"))
    merged = parts.groupBy("id").agg(F.flatten(F.collect_list(zipped)).alias("found"))
    return merged.select("id", F.slice(F.sort_array(F.array_distinct("found")), 1, k).alias("found"))


def taking_part(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vector) of rows with an id and a finite vector other than zero; of vectors of several
    lengths those of the length that most rows have take part, the longer of two equally frequent."""
    v = F.col(vec_col)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    good = vectors.filter(
        F.col(id_col).isNotNull() & v.isNotNull() & ~F.coalesce(F.exists(v, bad), F.lit(True)) & F.exists(v, lambda x: x != 0)
    ).select(F.col(id_col).cast("long").alias("id"), v.alias("vector"))
    counted = good.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    usual = counted.agg(F.max(F.struct("n", "length"))["length"]).first()[0]
    return good.filter(F.size("vector") == F.lit(usual))


def _levels(members: DataFrame, s: Settings, k: int) -> tuple[Hashes, Levels, DataFrame]:
    """Projections, levels and pools for these members, and the members with their ``level``.

    Levels are counted over all members, one row for each; a factor of RATIO lies between two levels, the
    longest vector is in the middle of the first. A pool is a seeded sample, the other one the longest
    vectors; both are bounded, and only tell queries from which score on it is worth to look.
    """
    top, dim = members.agg(F.max("norm"), F.max(F.size("vector"))).first()
    level = F.floor(F.log(F.col("norm") / F.lit(top or 1.0)) / F.lit(math.log(RATIO)) + 0.5).cast("long")
    members = members.withColumn("level", level)
    found = members.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest")).collect()
    total = sum(r["n"] for r in found)
    crowded = [r for r in found if r["n"] * CROWDED >= total]
    pair = lambda rows: tuple(sorted((r["level"], r["longest"]) for r in rows))
    size = max(2 * k, min(s.pool, POOL_BYTES // (8 * max(dim or 1, 1))))
    orders = (F.xxhash64(F.lit(s.seed), "id"), F.col("norm").desc())
    pool = {r["id"]: r["vector"] for o in orders for r in members.select("id", "vector", "norm").orderBy(o, "id").limit(size).collect()}
    ids = np.array(list(pool), dtype=np.int64)
    vectors = np.array(list(pool.values()), dtype=np.float64).reshape(len(ids), dim or 1)
    levels = Levels(pair(crowded), pair([r for r in found if r["n"] * CROWDED < total]), vectors, ids, k)
    return Hashes(s, dim or 1), levels, members


def search(
    vectors: DataFrame, every: int = 20, k: int = 20, s: Settings = Settings(), id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row whose id is divisible by ``every``.

    Every row but the query's own is a candidate. Nearness is the inner product, in double precision,
    of the vectors as given; ties go to the smaller id. Rows without id, and vectors that are null,
    zero or hold null or non-finite components take no part; repeated ids count as one; no rows give
    no rows. Of equal vectors only the k + 1 smallest ids can be among anyone's nearest, so only these
    are indexed, and equal queries are searched once. Vectors of like length form a level with buckets and a
    bound of its own, so that a few long ones don't blur the rest; a query passes over levels none of whose
    vectors can reach a score that it has k of already. Queries that find fewer than k (tiny tables) are
    compared with all candidates, block by block.
    """
    same_vector = Window.partitionBy("vector").orderBy("id")
    rows = taking_part(vectors, id_col, vec_col).dropDuplicates(["id"])
    kept = stored(rows, "ann-rows")
    members = kept.withColumn("place", F.row_number().over(same_vector)).filter(F.col("place") <= k + 1).drop("place")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    members = stored(members.withColumn("norm", norm), "ann-members")
    asked = kept.filter(F.col("id") % every == 0)
    queries = stored(asked.groupBy("vector").agg(F.min("id").alias("id")), "ann-queries")

    hashes, levels, members = _levels(members, s, k)
    n = members.count()
    cells = _placed(members, hashes, levels, 1, 1, None, False).unionByName(_placed(queries, hashes, levels, 1, 1, None, True))
    # a row for each cell: at most CROWDED * tables * buckets and one for each level, whatever the data
    per_cell = {
        r[0]: (r[1], r[2])
        for r in cells.groupBy("cell").agg(F.count_if(F.col("kind") == 0), F.count_if(F.col("kind") == 1)).collect()
    }
    sizes = (s.block_members, s.block_queries)
    placed = _placed(members, hashes, levels, *sizes, per_cell, False).unionByName(
        _placed(queries, hashes, levels, *sizes, per_cell, True)
    )
    found = stored(_ranked(placed, k + 1), "ann-found")

    enough = min(k + 1, n)
    short = queries.join(found.filter(F.size("found") >= enough), "id", "left_anti")
    lacking = short.count()
    if lacking:
        one = Levels((), ((0, math.inf),), levels.pool[:0], levels.pool_ids[:0], k)
        all_of = {0: (n, lacking)}
        whole = members.withColumn("level", F.lit(0))
        rest = _placed(whole, hashes, one, *sizes, all_of, False).unionByName(_placed(short, hashes, one, *sizes, all_of, True))
        found = found.join(short.select("id"), "id", "left_anti").unionByName(_ranked(rest, k + 1))

    groups = asked.select(F.col("id").alias("query_id"), "vector").join(
        queries.select("vector", F.col("id").alias("asked_as")), "vector"
    )
    lists = groups.select("query_id", "asked_as").join(found, F.col("asked_as") == F.col("id"))
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return lists.select("query_id", F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.far")).alias("score")
    )
