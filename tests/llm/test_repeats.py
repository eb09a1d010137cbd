"""Transforms, their merge and the removal of repeats, against all windows listed one by one."""

import collections
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.data import documents, frame
from tickspark.llm import bwt, repeats
from tickspark.llm.queries import QUERIES


def plain_order(strings):
    """(string, offset) of all suffixes; the end of string k is a symbol below all bytes, ends in the order of k."""
    found = [([x + len(strings) for x in s[i:]] + [k], k, i) for k, s in enumerate(strings) for i in range(len(s) + 1)]
    return [(k, i) for _, k, i in sorted(found)]


texts = st.lists(st.lists(st.integers(0, 2), min_size=0, max_size=12).map(bytes), min_size=1, max_size=8, unique=True).map(sorted)


@settings(max_examples=200, deadline=None)
@given(texts)
def test_transform_and_its_way_back(strings):
    symbols = bwt.transform(strings)
    order = plain_order(strings)
    assert symbols.tolist() == [strings[k][i - 1] + 1 if i else bwt.END for k, i in order]
    owner, offset = bwt.starts(symbols, bwt.following(symbols))
    assert list(zip(owner.tolist(), offset.tolist())) == order


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, min_size=1, max_size=4), st.integers(1, 9))
def test_merge_finds_all_repeated_intervals(shards, length):
    starts = collections.defaultdict(list)
    for s, strings in enumerate(shards):
        for k, data in enumerate(strings):
            for i in range(len(data) - length + 1):
                starts[data[i : i + length]].append((s, k, i))
    want = {p for places in starts.values() if len(places) > 1 for p in places}
    found = bwt.repeated([bwt.transform(s) for s in shards], length)
    got = [(s, *p) for s, (o, f) in enumerate(found) for p in zip(o.tolist(), f.tolist())]
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("length,gram", [(200, 40), (20, 5), (7, 7), (9, 1), (16, 4)])
def test_windows_know_their_least_gram(length, gram):
    rng = np.random.default_rng(1)
    data = rng.integers(0, 3, size=900).astype(np.uint8)
    first, place = repeats.least_grams(data, length, gram)
    again, later = repeats.least_grams(data[100:], length, gram)
    assert len(first) == len(data) - length + 1
    assert (first[100:] == again).all() and (place[100:] == later + 100).all()  # wherever the window lies
    one = repeats.least_grams(data, gram, gram)[0]
    order = lambda h: h >> np.uint64(repeats.PLACE_BITS)
    for i in range(0, len(first), 37):
        inside = order(one[i : i + length - gram + 1])
        assert place[i] == i + int(np.argmin(inside)) and first[i] == one[place[i]]


def test_stretches_hold_every_window_once(monkeypatch):
    rnd = random.Random(2)
    texts = [b"", b"short", b"a" * 5000, bytes(rnd.randrange(256) for _ in range(3000)), b"ab" * 700, b"x" * 200, b"y" * 199]
    for piece in (1 << 18, 1000, 300):
        monkeypatch.setattr(repeats, "PIECE", piece)
        seen = collections.Counter()
        for number, start, count, _, sums in repeats.stretches(texts):
            for n, s, c, d in zip(number.tolist(), start.tolist(), count.tolist(), sums):
                assert 0 < c <= 161
                assert repeats.xxh3_128_digest(texts[n][s : s + c + 199]) == d.tobytes()
                seen.update((n, i) for i in range(s, s + c))
        assert seen == {(n, i): 1 for n, t in enumerate(texts) for i in range(len(t) - 199)}


def plain(rows, length):
    starts = collections.defaultdict(list)
    data = [(t or "").encode() for _, t in rows]
    for n, d in enumerate(data):
        for i in range(len(d) - length + 1):
            starts[d[i : i + length]].append((n, i))
    gone = [bytearray(len(d)) for d in data]
    for places in starts.values():
        if len(places) > 1:
            for n, i in places:
                gone[n][i : i + length] = b"\1" * length
    out = []
    for (doc, _), d, g in zip(rows, data, gone):
        kept = bytes(x for x, y in zip(d, g) if not y)
        spans = sum(1 for i, y in enumerate(g) if y and (not i or not g[i - 1]))
        out.append((doc, len(d), sum(g), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(seed, count=150):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdefgé中", k=rnd.randrange(1, 9)))
    shared = [" ".join(word() for _ in range(rnd.choice([30, 60, 120]))) for _ in range(6)]
    shared.append("=" * 700)
    for n in range(count):
        parts = []
        for _ in range(rnd.randrange(1, 5)):
            base = rnd.choice(shared)
            cut = rnd.randrange(len(base))
            parts.append(rnd.choice([base, base[cut:], base[:cut], word() + base[cut : cut + 230], " ".join(word() for _ in range(40))]))
        if n % 10 == 0:  # periodic, and nowhere else
            parts.append("".join(rnd.choices("abcdefg", k=rnd.choice([1, 3, 17, 90]))) * rnd.choice([4, 40, 120]))
        yield n + 10_000, rnd.choice([" ", "", "\n"]).join(parts)


@pytest.mark.parametrize("data", ["abcdefghij" * 60, "a" * 201, "a" * 200, "xy" * 100 + "x", "0123456789" * 19 + "0123456789" * 3])
def test_repeats_inside_one_text_alone(spark, data):
    rows = [(1, "head " + data + " tail"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert digests(repeats.without_repeats(docs)) == plain(rows, 200)


def digests(found):
    return sorted(
        (
            (r.doc_id, r.n_bytes, sum(s["last"] - s["first"] for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest())
            for r in found.collect()
        ),
        key=str,
    )


@pytest.mark.parametrize(
    "length,more",
    [(200, {}), (200, {"bin_bytes": 4000, "shards": 3}), (200, {"crowded": 2000, "bin_bytes": 4000}), (60, {"gram": 12, "bin_bytes": 9000})],
)
def test_removal_equals_brute_force(spark, length, more):
    rows = list(passages(5)) + [(i, t) for i, t, *_ in documents() if len(t or "") < 9000]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    docs = docs.selectExpr("*", "1 AS text_key", "2 AS start", "3 AS bin", "4 AS n", "5 AS kept")
    assert digests(repeats.without_repeats(docs, length, **more)) == plain(rows, length)


def test_query_over_a_folder(spark, folder):
    rows = [r for r in documents(4) if len(r[1] or "") < 9000]
    frame(spark, rows, extra=True).write.parquet(f"{folder}/documents.parquet")
    got = QUERIES["op12_suffix_dedup"](spark, folder)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain([r[:2] for r in rows], 200)


def test_no_rows_and_no_repeats(spark):
    assert repeats.without_repeats(frame(spark, [])).collect() == []
    rows = [(1, "only once " + "".join(map(chr, range(60, 700)))), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert digests(repeats.without_repeats(docs)) == plain(rows, 200)
