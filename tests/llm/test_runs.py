"""Runs of repeated words against every start and period tried one by one."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.data import documents, frame
from tickspark.llm import runs
from tickspark.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=24, times=3):
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q):
                found.setdefault((i, length), q)  # periods come in rising order: the smallest stays
            i = max(j, i + 1)
    return sorted(((s, m, q) for (s, m), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words, found):
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts_with_runs(seed, count=120):
    rnd = random.Random(seed)
    for _ in range(count):
        vocab = [f"w{i}" for i in range(rnd.choice([1, 2, 3, 10, 500]))]
        out = []
        for _ in range(rnd.randrange(1, 5)):
            out += rnd.choices(vocab, k=rnd.randrange(0, 60))
            period = rnd.choices(vocab, k=rnd.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33, 40]))
            whole = period * rnd.randrange(1, 6) + period[: rnd.randrange(len(period) + 1)]
            out += whole
        yield out


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    for words in texts_with_runs(seed):
        data = " ".join(words).encode()
        ids = runs.word_numbers(data)
        found = runs.runs_of(ids)
        assert found == plain_runs(words)
        assert runs.collapsed(data, found, len(ids)).decode() == plain_collapsed(words, found)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90), st.integers(4, 12), st.integers(3, 5))
def test_runs_for_any_bounds(words, least, times):
    assert runs.runs_of(np.array(words, dtype=np.int32), least, times) == plain_runs(words, least, times)


def test_runs_inside_runs():
    word = ("a b " * 30 + "c ").split()
    words = word * 5
    assert runs.runs_of(runs.word_numbers(" ".join(words).encode())) == plain_runs(words)


def test_long_texts_take_linear_time():
    rnd = random.Random(3)
    period = [f"w{rnd.randrange(400)}" for _ in range(70_000)]
    words = ["x"] * 300_000 + period * 4
    found = runs.runs_of(runs.word_numbers(" ".join(words).encode()))
    assert found == [(0, 300_000, 1), (300_000, 280_000, 70_000)]


def test_texts_are_cut_at_blanks_only():
    data = "é x y\x1cz\x0b\x85w ".encode() * 50
    whole = [w.encode() for w in WORD.findall(data.decode())]
    for size in (1, 2, 7, 64, 10_000):
        assert [w for part in runs.word_chunks(data, size) for w in part] == whole


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = planted(doc_id, WORD.findall(text or "")) if doc_id is not None else WORD.findall(text or "")
    found = plain_runs(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(found), *best, milli, digest(listed), digest(plain_collapsed(words, found)))


NAMES = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_over_all_kinds_of_documents(spark, folder):
    rows = [r for r in documents() if len(r[1] or "") < 20_000]
    rows += [(5000 + i, " ".join(w), "en", "s1", 0) for i, w in enumerate(texts_with_runs(9, 60))]
    frame(spark, rows, extra=True).write.parquet(f"{folder}/documents.parquet")
    got = QUERIES["op11_periodic_runs"](spark, folder)
    assert got.columns == list(NAMES)
    key = lambda r: str(r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted((expected(r[0], r[1]) for r in rows), key=key)
    assert any(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows)


def test_no_rows(spark):
    assert runs.periodic_runs(frame(spark, [])).collect() == []
