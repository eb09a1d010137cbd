"""Clusters against plain Python integers."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickspark.llm import pivots


def plain(rows, count, rounds, dims, scale=256, salt="2:"):
    good = [
        (i, [math.floor(Fraction(x) * scale) for x in v], v)
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    name = lambda i: hashlib.sha256(f"{salt}{'' if i is None else i}".encode()).hexdigest()
    centres = [v for _, v, _ in sorted(good, key=lambda r: (name(r[0]), r[2]))[:count]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))
    for _ in range(rounds):
        own = {}
        for _, v, _ in good:
            own.setdefault(near(v)[1], []).append(v)
        centres = [[sum(x) // len(own[k]) for x in zip(*own[k])] if k in own else c for k, c in enumerate(centres)]
    placed = [(i, *near(v)[::-1]) for i, v, _ in good]
    most = 2**63 - 1
    inertia = {}
    for _, c, d in placed:
        inertia[c] = inertia.get(c, 0) + d
    digest = lambda c: hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()
    every = min(sum(inertia.values()), most)
    return sorted(((i, c, min(d, most), min(inertia[c], most), every, digest(c)) for i, c, d in placed), key=str)


def made(spark, rows, kind="double", parts=4):
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(parts)
    return table.select("*", *[F.lit(1).alias(c) for c in ("far", "cluster", "distance", "label", "name", "limb")])


def got(table, **more):
    return sorted(map(tuple, pivots.clusters(table, **more).collect()), key=str)


@pytest.mark.parametrize("seed,kind", [(1, "float"), (2, "double")])
def test_clusters_equal_plain_integers(spark, seed, kind):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 6))
    rows = [(i, (centres[i % 12] + rng.normal(scale=0.4, size=6)).astype(np.float32).tolist()) for i in range(700)]
    rows += [(i, [round(x) / 256 for x in v]) for i, v in rows[:150]]  # ties and repeated ids
    rows += [rows[3]] * 40 + [(None, rows[5][1]), (None, rows[6][1])]
    rows += [(9000, None), (9001, []), (9002, [1.0] * 5), (9003, [1.0] * 7), (9004, [None] + [1.0] * 5), (9005, [float("nan")] * 6), (9006, [float("-inf")] * 6)]
    assert got(made(spark, rows, kind), count=20, dims=6, pivots=3) == plain(rows, 20, 5, 6)


def test_huge_components_stay_exact(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.choice([1.7e308, -1e308, 3e15, 1e5, 0.3, -2.0]) for _ in range(3)]) for i in range(120)]
    assert got(made(spark, rows), count=7, dims=3) == plain(rows, 7, 5, 3)


def test_grid_full_of_ties(spark):
    rows = [(i, [float(i % 5), float(i // 5 % 5)]) for i in range(100)]
    assert got(made(spark, rows), count=9, dims=2, pivots=4) == plain(rows, 9, 5, 2)


def test_few_or_no_vectors(spark):
    rows = [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, None)]
    assert got(made(spark, rows), dims=2) == plain(rows, 40, 5, 2)
    assert got(made(spark, rows[2:]), dims=2) == []
    assert pivots.clusters(made(spark, rows[2:]), dims=2).columns == pivots.clusters(made(spark, rows), dims=2).columns


def test_bounds_spare_exact_distances(spark, monkeypatch):
    rng = np.random.default_rng(0)
    centres = rng.integers(-2000, 2000, size=(40, 8))
    rows = np.repeat(centres, 30, axis=0) + rng.integers(-20, 20, size=(1200, 8))
    fixed = pivots.spread(centres, 8)
    far = pivots.to_pivots(rows, fixed)
    measured = []
    exact = pivots.squared
    monkeypatch.setattr(pivots, "squared", lambda r, c: measured.append(len(r)) or exact(r, c))
    best, found = pivots.nearest(rows, far, centres, fixed)
    want = ((rows[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (best == want.argmin(axis=1)).all() and (found == want.min(axis=1)).all()
    assert sum(measured) < 0.25 * len(rows) * len(centres)
