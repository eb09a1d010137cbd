"""Very long runs, and texts with very many matches, take time in proportion."""

import random
import string
import time

import pytest
from pyspark.sql import functions as F

from tests.llm.data import documents, frame
from tickspark.llm import secrets

LETTERS = string.ascii_letters + string.digits


@pytest.fixture(scope="module")
def model(spark):
    return secrets.train(secrets.default_samples(frame(spark, documents())))


def spans_of(spark, model, texts):
    table = frame(spark, [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)])
    found, names = secrets.with_spans(table, model)
    return {r.doc_id: r for r in found.select("doc_id", *[F.col(n).alias(k) for n, k in zip(names, secrets.KINDS)]).collect()}


def test_a_run_of_a_million_characters(spark, model):
    rnd = random.Random(1)
    spans_of(spark, model, ["warm up " + "".join(rnd.choices(LETTERS, k=500))])
    text = "".join(rnd.choices(LETTERS, k=1_000_000))
    started = time.time()
    got = spans_of(spark, model, [text])[0]
    assert time.time() - started < 60
    covered = sum(x.stop - x.start for x in got.random)
    assert covered > 0.98 * len(text)


def test_many_matches_in_one_text(spark, model):
    rnd = random.Random(2)
    keys = ["".join(rnd.choices(LETTERS, k=24)) for _ in range(20_000)]
    text = " ".join(f"password={k}" for k in keys)
    started = time.time()
    got = spans_of(spark, model, [text])[0]
    assert time.time() - started < 60
    assert len(got.assign) == len(keys) and not got.random
    at = 0
    for x, k in zip(got.assign, keys):
        assert (x.start, x.stop) == (at, at + 9 + len(k))
        at = x.stop + 1


def test_redaction_of_many_spans(spark):
    rnd = random.Random(3)
    parts = [("password=" + "".join(rnd.choices(LETTERS, k=12)), secrets.PLACEHOLDER) if i % 3 else (f"é{i} ", f"é{i} ") for i in range(3000)]
    text, want = " ".join(p for p, _ in parts), " ".join(w for _, w in parts)
    clean = secrets.redacted(frame(spark, [(1, text, "en", "s", len(text))])).first()
    assert clean.text == want and clean.n_chars == len(want)


def test_words_of_all_documents_count(spark):
    docs = frame(spark, [(i, "alpha beta alpha " + "x" * i, "en", "s", 0) for i in range(50)] + [(99, None, None, None, None)])
    assert {r.word: r.n for r in secrets.corpus_words(docs).collect() if r.word in ("alpha", "beta")} == {"alpha": 100, "beta": 50}
