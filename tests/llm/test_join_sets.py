"""What the join packs and how it fetches sets again: gaps, many copies beside a representative, the join by id."""

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.data import documents, frame
from tests.llm.test_operators import brute_groups, counted
from tickspark.llm import jaccard


@pytest.mark.parametrize("count,below", [(0, 1), (1, 1), (1, 1 << 20), (1000, 1 << 20), (3, 1 << 20), (50_000, 1 << 16), (40, 1 << 14)])
def test_gaps_come_back(count, below):
    values = np.sort(np.random.default_rng(count).choice(below, min(count, below), replace=False).astype(np.int64))
    raw = jaccard.pack_gaps(values)
    assert jaccard.unpack_gaps(raw).tolist() == values.tolist() and len(raw) <= 3 * len(values)


def test_texts_come_in_order_with_nulls():
    texts = [None if i % 7 == 0 else f"t{i}" for i in range(3 * jaccard.TEXTS + 5)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    assert [t if t is None else t.decode() for t in jaccard._texts(batch)] == texts


@pytest.mark.parametrize("most", [0, jaccard.SPOT_BITS])
def test_copies_and_null_ids_with_either_way_to_fetch_sets(spark, monkeypatch, most):
    monkeypatch.setattr(jaccard, "SPOT_BITS", most)
    rows = documents(6)
    base = next(r[1] for r in rows if r[1] and 60 < len(r[1].split()) < 200)
    near = " ".join(base.split()[:-1])
    rows += [(None, near + " only null ids", "en", "s1", 1)] * 2 + [(9000 + k, base, "en", "s1", 1) for k in range(300)]
    rows += [(9500, near, "en", "s2", 1)] * 3
    got = jaccard.near_groups(frame(spark, rows), jaccard.Settings(frequent=2, block=16)).collect()
    assert counted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(rows)
