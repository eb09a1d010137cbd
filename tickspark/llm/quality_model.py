"""Quality by logistic regression over hashed word n-grams, trained with follow-the-regularised-leader."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import held_out, per_process
from .labelled import label_sample

CACHE_ENTRIES = 300_000


@dataclass(frozen=True)
class Settings:
    """The sample holds at most ``rows`` texts of each label, of at most ``longest`` characters."""

    bits: int = 18
    orders: tuple[int, ...] = (1, 2)
    rows: int = 4000
    longest: int = 20_000
    epochs: int = 3
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.1
    seed: int = 5


def word_codes(word: str) -> tuple[int, int]:
    """Hash of the word itself, and of its shape: kind of case and the marks around its letters."""
    letters = [c for c in word if c.isalnum()]
    marks = "".join(c for c in word if not c.isalnum())[:8]
    core = "".join(letters)
    kind = "0" if not core else "U" if core.isupper() and len(core) > 1 else "T" if core[0].isupper() else "l" if core.isalpha() else "m"
    return zlib.crc32(b"w" + word.lower().encode("utf-8", "replace")), zlib.crc32(f"s{kind}{marks}".encode("utf-8", "replace"))


class Hasher:
    """Hashed n-grams of whole texts. Words are numbered as they come; codes are kept by number."""

    def __init__(self, s: Settings):
        self.s, self.mask = s, np.uint64((1 << s.bits) - 1)
        self.reset()

    def reset(self) -> None:
        self.numbers: dict[str, int] = {}
        self.codes = np.empty((1024, 2), dtype=np.uint64)

    def number(self, words: list[str]) -> np.ndarray:
        if len(self.numbers) > CACHE_ENTRIES:
            self.reset()
        known = self.numbers
        for w in set(words).difference(known):
            n = len(known)
            if n == len(self.codes):
                self.codes = np.concatenate([self.codes, np.empty_like(self.codes)])
            self.codes[n] = word_codes(w)
            known[w] = n
        return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))

    def features(self, text: str) -> np.ndarray:
        """Buckets of all n-grams of words and of word shapes, with repetition."""
        words = text.split()
        if not words:
            return np.zeros(0, dtype=np.int64)
        codes = self.codes_of(words)
        out = []
        for column in (0, 1):
            base = codes[:, column]
            for order in self.s.orders:
                if len(base) < order:
                    continue
                span = len(base) - order + 1
                mixed = base[:span] + np.uint64(order)
                for k in range(1, order):
                    mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + base[k : span + k]
                    if column:  # a shape n-gram also tells whether the word stays the same
                        mixed += codes[k : span + k, 0] == codes[k - 1 : span + k - 1, 0]
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                out.append((mixed >> np.uint64(32)) & self.mask)
        return np.concatenate(out).astype(np.int64)

    def codes_of(self, words: list[str]) -> np.ndarray:
        at = self.number(words)
        return self.codes[at]


def fit(sample: pd.DataFrame, s: Settings = Settings()) -> tuple[np.ndarray, float]:
    """FTRL-proximal over the sample in a seeded order; returns the weights and the bias.

    A document is a sparse vector of n-gram counts over the root of their number. Classes are weighted
    by nothing: the sample should carry the odds that scores are to have.
    """
    size = 1 << s.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last one is the bias
    hasher, rows = Hasher(s), []
    for text in sample["text"]:
        found = hasher.features(text)
        own, count = np.unique(found, return_counts=True)
        rows.append((np.append(own, size), np.append(count / np.sqrt(max(len(found), 1)), 1.0)))
    label = sample["label"].to_numpy(dtype=float)

    def weights(i):
        shrunk = np.sign(z[i]) * np.maximum(np.abs(z[i]) - s.l1, 0.0)
        return -shrunk / ((s.beta + np.sqrt(n[i])) / s.alpha + s.l2)

    rng = np.random.default_rng(s.seed)
    for _ in range(s.epochs):
        for k in rng.permutation(len(rows)):
            i, x = rows[k]
            w = weights(i)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - label[k]) * x
            now = n[i] + g * g
            z[i] += g - (np.sqrt(now) - np.sqrt(n[i])) / s.alpha * w
            n[i] = now
    w = weights(np.arange(size + 1))
    return w[:size].astype(np.float32), float(w[size])


def score(docs: DataFrame, weights: np.ndarray, bias: float, s: Settings = Settings()) -> DataFrame:
    """(doc_id, score): probability of label 1 for each whole text, a sparse dot product.

    Null and empty texts get the probability of the bias; null ids and repeated rows stay; no rows
    give no rows. The model is 2 ** ``s.bits`` floats whatever the corpus.
    """

    def run(batches):
        hasher = per_process(f"quality:{s}", lambda: Hasher(s))
        for b in batches:
            found = []
            for t in b.column(b.schema.get_field_index("text")):
                at = hasher.features(t.as_py() or "")
                odds = float(weights[at].sum(dtype=np.float64)) / np.sqrt(max(len(at), 1)) + bias
                found.append(float(1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500)))))
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index("doc_id")), pa.array(found, pa.float64())], ["doc_id", "score"]
            )

    slim = docs.select("doc_id", "text")
    return slim.mapInArrow(run, f"doc_id {dict(slim.dtypes)['doc_id']}, score double")


def quality(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Fit on the labelled sample and score all documents: (doc_id, held_out, score, predicted)."""
    sample = label_sample(docs, labels, "quality", {1: s.rows, 0: s.rows}, s.longest, s.seed)
    weights, bias = fit(sample, s)
    return score(docs, weights, bias, s).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )
