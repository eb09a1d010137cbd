"""Clusters around centroids; a table of distances to fixed pivots spares most exact distances."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

PIVOTS = 8
BLOCK = 2048  # vectors compared at a time
PLAIN = 1 << 27  # below it 64-bit integers hold every sum of squares of up to 64 components
FAR = 10**300  # squares as doubles end here, so that nothing overflows
LIMB = 48  # bits of a number that are summed at a time
MOST = (1 << 63) - 1


def is_whole(vector: str, dims: int) -> Column:
    """Exactly ``dims`` components, none null, NaN or infinite."""
    value = F.col(vector)
    good = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(value) == dims) & good, F.lit(False))


def integers(rows: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of every component: 64-bit integers, or Python's where those might not do."""
    if not rows.size or float(np.abs(rows).max()) < PLAIN / scale:
        return np.floor(rows * scale).astype(np.int64)
    exact = [[Fraction(x) * scale // 1 for x in row] for row in rows.tolist()]
    return np.array(exact, dtype=object).reshape(rows.shape)


def squared(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows to one centre."""
    if rows.dtype == object or max(map(abs, centre.tolist()), default=0) >= PLAIN:
        rows, centre = rows.astype(object), centre.astype(object)
    gap = rows - centre
    return (gap * gap).sum(axis=1)


def doubles(squares: np.ndarray) -> np.ndarray:
    """Exact squares as doubles, those above FAR as that."""
    if squares.dtype == object:
        squares = np.array([min(x, FAR) for x in squares.tolist()])
    return squares.astype(np.float64)


def length(squares: np.ndarray) -> np.ndarray:
    """Roots of exact squares, right to a relative 2^-50; cut at one length, they differ by no more than before."""
    return np.sqrt(doubles(squares))


def spread(centres: np.ndarray, pivots: int) -> np.ndarray:
    """Pivots among the first centroids: each the one furthest from those before it."""
    chosen = [0]
    nearest = squared(centres, centres[0])
    while len(chosen) < min(pivots, len(centres)):
        chosen.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, squared(centres, centres[chosen[-1]]))
    return centres[chosen]


def to_pivots(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([length(squared(rows, p)) for p in pivots], axis=1)


def nearest(rows: np.ndarray, far: np.ndarray, centres: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(centroid number, exact squared distance) of the nearest centroid, the smaller number of equals.

    No centroid is nearer than its distance to a pivot differs from the vector's (``far``). A vector is
    measured against the centroid of the least such bound first; of the others only those whose bound,
    less the error of its roots, does not exceed the best distance so far receive exact distances.
    """
    seen = to_pivots(centres, pivots)
    bound = np.abs(far[:, None, :] - seen[None, :, :]).max(axis=2)
    bound = np.maximum(bound - 1e-9 * (1.0 + far.max(axis=1)[:, None] + seen.max(axis=1)[None, :]), 0.0)
    bound = bound * bound * (1 - 1e-9)
    best = np.argmin(bound, axis=1)
    exact = np.zeros(len(rows), dtype=rows.dtype if centres.dtype != object else object)
    for c in np.unique(best):
        own = best == c
        exact[own] = squared(rows[own], centres[c])
    first = best.copy()
    for c in range(len(centres)):
        left = np.flatnonzero((bound[:, c] <= doubles(exact) * (1 + 1e-9)) & (first != c))
        if len(left):
            found = squared(rows[left], centres[c])
            nearer = (found < exact[left]) | ((found == exact[left]) & (c < best[left]))
            exact[left[nearer]], best[left[nearer]] = found[nearer], c
    return best, exact


def _blocks(batch: pa.RecordBatch, vector: str, dims: int) -> Iterator[tuple[int, np.ndarray]]:
    values = batch.column(batch.schema.get_field_index(vector)).flatten().to_numpy(zero_copy_only=False)
    rows = values.astype(np.float64).reshape(-1, dims)
    for at in range(0, len(rows), BLOCK):
        yield at, rows[at : at + BLOCK]


def _limbs(number: int) -> list[int]:
    """Signed pieces of a number, LIMB bits each, the least first."""
    sign, rest, pieces = (-1, -number, []) if number < 0 else (1, number, [])
    while rest:
        pieces.append(sign * (rest & ((1 << LIMB) - 1)))
        rest >>= LIMB
    return pieces


def _sums(frame: DataFrame, vector: str, dims: int, scale: int, centres: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """Per task and centroid the count and componentwise sums of its vectors, as rows of limbs."""
    names = ["cluster", "limb", "n", *[f"s{i}" for i in range(dims)]]

    def run(batches):
        counts = np.zeros(len(centres), dtype=np.int64)
        sums = [[0] * dims for _ in centres]
        for b in batches:
            far = np.array(b.column(b.schema.get_field_index("far")).flatten()).reshape(-1, len(pivots))
            for at, block in _blocks(b, vector, dims):
                rows = integers(block, scale)
                best, _ = nearest(rows, far[at : at + len(block)], centres, pivots)
                for c in np.unique(best):
                    own = rows[best == c]
                    counts[c] += len(own)
                    sums[c] = [x + int(y) for x, y in zip(sums[c], own.sum(axis=0).tolist())]
        out = []
        for c in np.flatnonzero(counts):
            pieces = [_limbs(x) for x in sums[c]]
            for k in range(max(1, *map(len, pieces))):
                row = [p[k] if k < len(p) else 0 for p in pieces]
                out.append([int(c), k, int(counts[c]) if k == 0 else 0, *row])
        columns = list(zip(*out)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(col, pa.int64()) for col in columns], names)

    return frame.select(vector, "far").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _moved(frame: DataFrame, vector: str, dims: int, scale: int, centres: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Centroids after one round. What comes to the driver has a row per centroid and limb."""
    names = [f"s{i}" for i in range(dims)]
    total = lambda n: F.sum(F.col(n).cast("decimal(38,0)")).alias(n)
    parts = _sums(frame, vector, dims, scale, centres, pivots).groupBy("cluster", "limb").agg(total("n"), *map(total, names))
    counts: dict[int, int] = {}
    sums: dict[int, list[int]] = {}
    for row in parts.collect():
        c, shift = int(row["cluster"]), LIMB * int(row["limb"])
        counts[c] = counts.get(c, 0) + int(row["n"])
        own = sums.setdefault(c, [0] * dims)
        sums[c] = [x + int(row[n]) * (1 << shift) for x, n in zip(own, names)]
    moved = [[x // counts[c] for x in sums[c]] if c in counts else centres[c].tolist() for c in range(len(centres))]
    return _array(moved, dims)


def _array(rows: list[list[int]], dims: int) -> np.ndarray:
    plain = all(abs(x) < PLAIN for row in rows for x in row)
    return np.array(rows, dtype=np.int64 if plain else object).reshape(len(rows), dims)


def clusters(
    vectors: DataFrame,
    count: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: int = 256,
    pivots: int = PIVOTS,
    salt: str = "2:",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part.

    Vectors with exactly ``dims`` finite components take part, each as the integers floor(scale * x). The
    first centroids are the ``count`` vectors with the smallest sha256 of salt and id; a round assigns every
    vector to its nearest centroid and moves each centroid that has vectors to the floor of their mean; then
    vectors are assigned once more. All distances, sums and means are exact.

    Each vector's distances to a few of the first centroids, the pivots, are worked out once and stored with
    it. A round is one pass over that table; a task holds one block of it, and only sums travel.

    Fewer vectors than ``count`` give that many centroids; no vectors, no rows. Null ids hash as the salt
    alone; of rows with one id the smaller vector comes first. Repeated rows are each assigned. Numbers beyond
    64 bits are worked with in full; distances and inertias above 2^63 - 1 are returned as that.
    """
    named = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    whole = vectors.filter(is_whole(vector_col, dims)).select(id_col, F.col(vector_col).cast("array<double>").alias(vector_col))
    first = whole.select(named.alias("name"), vector_col).orderBy("name", vector_col).limit(count).collect()
    kind = dict(whole.dtypes)[id_col]
    names = ["cluster", "distance"]
    shape = f"`{id_col}` {kind}, cluster int, distance long"
    if not first:
        more = "cluster_inertia long, inertia long, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], f"{shape}, {more}")
    centres = _array([integers(np.array([r[1]]), scale)[0].tolist() for r in first], dims)
    fixed = spread(centres, pivots)

    def measured(batches):
        for b in batches:
            far = [to_pivots(integers(rows, scale), fixed) for _, rows in _blocks(b, vector_col, dims)]
            flat = np.concatenate(far).ravel() if far else np.empty(0)
            ends = np.arange(0, len(flat) + 1, len(fixed), dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], [*b.schema.names, "far"])

    table = stored(
        whole.mapInArrow(measured, f"`{id_col}` {kind}, `{vector_col}` array<double>, far array<double>"), "pivots"
    )
    for _ in range(rounds):
        centres = _moved(table, vector_col, dims, scale, centres, fixed)

    def assigned(batches):
        for b in batches:
            far = np.array(b.column(b.schema.get_field_index("far")).flatten()).reshape(-1, len(fixed))
            best, exact = [], []
            for at, block in _blocks(b, vector_col, dims):
                own, found = nearest(integers(block, scale), far[at : at + len(block)], centres, fixed)
                best += own.tolist()
                exact += [min(int(x), MOST) for x in found.tolist()]
            columns = [b.column(b.schema.get_field_index(id_col)), pa.array(best, pa.int32()), pa.array(exact, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, *names])

    final = stored(table.mapInArrow(assigned, shape), "assigned")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = final.groupBy("cluster").agg(total.alias("own")).collect()  # a row per centroid
    every = min(sum(int(r["own"]) for r in inertia), MOST)
    digest = lambda c: sha256(",".join(map(str, centres[c].tolist())).encode()).hexdigest()
    known = {int(r["cluster"]): (min(int(r["own"]), MOST), digest(int(r["cluster"]))) for r in inertia}
    own = F.create_map(*[F.lit(x) for c, (value, _) in known.items() for x in (c, value)])
    names_of = F.create_map(*[F.lit(x) for c, (_, text) in known.items() for x in (c, text)])
    return final.select(
        id_col,
        *names,
        own[F.col("cluster")].cast("long").alias("cluster_inertia"),
        F.lit(every).cast("long").alias("inertia"),
        names_of[F.col("cluster")].alias("centroid_sha256"),
    )
