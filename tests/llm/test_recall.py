"""Recall of the neighbours with default settings, on vectors of one length and of many."""

import numpy as np
import pytest

from tickspark.llm import ann


def lengths(kind, n, rng):
    if kind == "log-normal":
        return np.exp(rng.normal(0, 0.5, size=n))
    out = np.ones(n)
    if kind.startswith("one times"):
        out[7] = float(kind.split()[-1])
    return out


@pytest.mark.parametrize("kind", ["equal", "log-normal", "one times 2", "one times 4", "one times 1000"])
def test_recall(spark, kind):
    rng = np.random.default_rng(6)
    n, k = 2500, 20
    x = rng.normal(size=(n, 32))
    x *= (lengths(kind, n, rng) / np.sqrt((x**2).sum(axis=1)))[:, None]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {}
    for r in ann.search(table, k=k).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(found) == set(range(0, n, 20)) and all(len(f) == k for f in found.values())
    hits = 0
    for q, got in found.items():
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(got & set(np.argsort(-score)[:k].tolist()))
    assert hits / (k * len(found)) >= 0.9


def test_levels_no_member_of_which_can_be_near_are_passed_over():
    rng = np.random.default_rng(1)
    s = ann.Settings()
    x = np.concatenate([rng.normal(size=(300, 8)), 1e-3 * rng.normal(size=(300, 8))])
    levels = ann.Levels(((0, 6.0), (9, 0.006)), ((4, 0.5),), x[:300], np.arange(300), 20)
    _, cell = ann._cells(s, ann.Hashes(s, 8), levels, np.arange(300), x[:300], None)
    assert len(cell) and cell.max() < s.tables * s.buckets
