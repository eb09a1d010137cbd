"""Toxicity by subword-bag embeddings averaged into a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import held_out, per_process
from .labelled import label_sample

BLOCK_CHARS = 1 << 19


@dataclass(frozen=True)
class Settings:
    """``window`` words are averaged at a time, every half window. The sample to fit on holds at most
    ``toxic_rows`` + ``clean_rows`` texts of at most ``longest`` characters."""

    buckets: int = 1 << 16
    width: int = 8
    grams: tuple[int, ...] = (3, 4, 5)
    window: int = 16
    least_bag: int = 100
    toxic_rows: int = 2500
    clean_rows: int = 3500
    longest: int = 8_000
    epochs: int = 4
    rate: float = 0.3
    batch: int = 1024
    least_steps: int = 50
    seed: int = 5


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return per_process(
        "letters", lambda: np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    )


@dataclass
class Bags:
    """Subwords of some texts: ``flat`` holds the buckets of word 0, of word 1, and so on; word w has
    flat[offset[w]:offset[w + 1]], text t the words first[t]:first[t + 1]."""

    flat: np.ndarray
    offset: np.ndarray
    first: np.ndarray


def bags(texts: list[str], s: Settings) -> Bags:
    """Character n-grams of every word (run of letters, in lower case, with its edges), hashed.

    A word that repeats the word before it in the same text is left out: it adds nothing to a bag.
    """
    pad = max(s.grams)
    joined = "\n".join(texts).lower() if texts else ""
    code = np.frombuffer(("\n" + joined + "\n" * pad).encode("utf-32-le", "replace"), dtype=np.uint32)
    ends = None
    if len(texts) > 1:
        # lower() can change lengths, so texts are measured after it
        ends = np.cumsum([len(t.lower()) + 1 for t in texts])
    is_letter = letters()[code]
    word_start = is_letter[1:] & ~is_letter[:-1]
    at_start = np.flatnonzero(word_start) + 1
    word_of = np.cumsum(np.concatenate([[False], word_start])) - 1
    texts_first = (
        np.searchsorted(at_start, np.concatenate([[0], ends]) + 1) if ends is not None else np.array([0, len(at_start)])
    )[: len(texts) + 1]
    shown = np.where(is_letter, code, np.uint32(0))
    n = len(code) - pad
    found_word, found_bucket = [], []
    mark = np.zeros(len(at_start) + 1, dtype=np.uint64)
    for size in s.grams:
        inner = is_letter[1 : n + 1].copy()
        for k in range(2, size - 1):
            inner &= is_letter[k : n + k]
        at = np.flatnonzero(inner)
        h = np.full(len(at), size, dtype=np.uint32)
        for k in range(size):
            h = (h ^ shown[at + k]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        found_word.append(word_of[at + 1])
        found_bucket.append(h % np.uint32(s.buckets))
        if size == s.grams[0]:  # a mark by which equal neighbours are told; order counts
            spread = h.astype(np.uint64) * (np.uint64(0x9E3779B97F4A7C15) + np.uint64(2) * (at + 1 - at_start[word_of[at + 1]]).astype(np.uint64))
            run = np.concatenate([[np.uint64(0)], np.cumsum(spread)])
            edge = np.searchsorted(found_word[0], np.arange(len(at_start) + 1))
            mark = run[edge[1:]] - run[edge[:-1]]
    keep = np.ones(len(at_start), dtype=bool)
    if len(at_start) > 1:
        keep[1:] = mark[1:] != mark[:-1]
        heads = texts_first[:-1]
        keep[heads[heads < len(keep)]] = True
    words, buckets = np.concatenate(found_word), np.concatenate(found_bucket)
    left = keep[words] if len(words) else np.zeros(0, dtype=bool)
    number = np.cumsum(keep) - 1
    words, buckets = number[words[left]], buckets[left]
    order = np.argsort(words, kind="stable")
    kept = int(keep.sum())
    offset = np.searchsorted(words[order], np.arange(kept + 1))
    before = np.concatenate([[0], np.cumsum(keep)])
    return Bags(buckets[order].astype(np.int64), offset, before[texts_first])


def windows(b: Bags, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, word after the last) of windows every half window over each text's words."""
    words = np.diff(b.first)
    step = max(1, window // 2)
    count = np.maximum(1, -(-(words - window) // step) + 1)
    text = np.repeat(np.arange(len(words)), count)
    place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = b.first[text] + place * step
    return text, start, np.minimum(start + window, b.first[text + 1])


def sample_windows(texts: list[str], s: Settings) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Subwords of all texts one after the other, and (text, first subword, last + 1) of each window."""
    flat, found, texts_before, before = [], [], 0, 0
    kind = np.uint16 if s.buckets <= 1 << 16 else np.uint32
    for block in blocks(texts):
        b = bags(block, s)
        text, start, stop = windows(b, s.window)
        found.append((text + texts_before, b.offset[start] + before, b.offset[stop] + before))
        flat.append(b.flat.astype(kind))
        texts_before += len(block)
        before += len(b.flat)
    return np.concatenate(flat), tuple(np.concatenate(x) for x in zip(*found))


def fit(sample: pd.DataFrame, s: Settings = Settings()) -> tuple[np.ndarray, float]:
    """Train embeddings and softmax together; returns each bucket's weight in the logit, and the bias.

    A text is toxic if some window is. Clean texts give clean windows. Of a toxic text all windows
    count as toxic in the first epoch; after it only those that score high, or its best one. As
    embeddings are averaged and the softmax is linear, scoring needs only the product of each
    bucket's embedding with the difference of the two softmax columns. No rows give a constant model.
    """
    if sample.empty:
        return np.zeros(s.buckets, dtype=np.float32), -2.0
    rng = np.random.default_rng(s.seed)
    emb = rng.normal(0, 1 / s.width, (s.buckets, s.width)).astype(np.float32)
    soft, bias = np.zeros((s.width, 2)), np.zeros(2)
    past = [np.full_like(emb, 1e-6), np.full_like(soft, 1e-6), np.full_like(bias, 1e-6)]
    flat, (text, low, high) = sample_windows(list(sample["text"]), s)
    filled = high > low
    text, low, high = text[filled], low[filled], high[filled]
    label = sample["label"].to_numpy(dtype=np.int64)
    target, live = label[text], np.ones(len(text), dtype=bool)

    def grams(pick):
        size = high[pick] - low[pick]
        edge = np.concatenate([[0], np.cumsum(size)])
        return flat[np.repeat(low[pick] - edge[:-1], size) + np.arange(edge[-1])], edge[:-1], size

    for epoch in range(s.epochs):
        if epoch:
            weight = (emb @ (soft[:, 1] - soft[:, 0])).astype(np.float32)
            odds = np.empty(len(text))
            for i in range(0, len(text), s.batch):  # windows are in the order of their subwords
                part = slice(i, i + s.batch)
                lead = low[part].min()
                summed = np.concatenate([[0.0], np.cumsum(weight[flat[lead : high[part].max()]], dtype=np.float64)])
                odds[part] = summed[high[part] - lead] - summed[low[part] - lead]
            odds = odds / np.maximum(high - low, s.least_bag) + bias[1] - bias[0]
            best = np.full(len(label), -np.inf)
            np.maximum.at(best, text, odds)
            live = (label[text] == 0) | (odds > 0) | (odds >= best[text])
        order = rng.permutation(np.flatnonzero(live))
        size_of = int(np.clip(len(order) // s.least_steps, 32, s.batch))  # small samples take small steps
        for i in range(0, len(order), size_of):
            pick = order[i : i + size_of]
            ids, edge, size = grams(pick)
            count = np.maximum(size, s.least_bag)[:, None]
            h = np.add.reduceat(emb[ids], edge, axis=0) / count
            z = h @ soft + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(pick)), target[pick]] -= 1.0
            p /= len(pick)
            back = np.repeat(p @ soft.T / count, size, axis=0)
            to_emb = np.stack([np.bincount(ids, back[:, d], minlength=s.buckets) for d in range(s.width)], axis=1)
            for value, grad, seen in ((soft, h.T @ p, past[1]), (bias, p.sum(axis=0), past[2]), (emb, to_emb, past[0])):
                seen += grad**2
                value -= s.rate * grad / np.sqrt(seen)
    # multiples of 2^-16 add up exactly, whatever else a batch holds
    weights = (np.round((emb @ (soft[:, 1] - soft[:, 0])) * 65536) / 65536).astype(np.float32)
    return weights, centred(sample, weights, float(bias[1] - bias[0]), s)


def centred(sample: pd.DataFrame, weights: np.ndarray, bias: float, s: Settings) -> float:
    """The bias with which even odds lie midway between the labels: a long text has many windows and
    so a higher maximum than a single window. Half a percent at either side is left to mislabelled rows."""
    odds = np.concatenate([odds_of(block, weights, bias, s) for block in blocks(list(sample["text"]))])
    toxic = sample["label"].to_numpy() == 1
    if toxic.all() or not toxic.any():
        return bias
    low, high = np.quantile(odds[~toxic], 0.995), np.quantile(odds[toxic], 0.005)
    return bias - float(max((low + high) / 2, 0.0))


def odds_of(texts: list[str], weights: np.ndarray, bias: float, s: Settings) -> np.ndarray:
    """Highest log-odds among the windows of each text; a text without letters has the bias alone."""
    b = bags(texts, s)
    text, start, stop = windows(b, s.window)
    summed = np.concatenate([[0.0], np.cumsum(weights[b.flat], dtype=np.float64)])
    low, high = b.offset[start], b.offset[stop]
    odds = (summed[high] - summed[low]) / np.maximum(high - low, s.least_bag) + bias
    heads = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    return np.maximum.reduceat(odds, heads)


def blocks(texts: list[str]) -> Iterator[list[str]]:
    """Runs of neighbouring texts of about a million characters; a longer text is a run of its own."""
    now, size = [], 0
    for t in texts:
        if now and size + len(t) > BLOCK_CHARS:
            yield now
            now, size = [], 0
        now.append(t)
        size += len(t) + 1
    if now:
        yield now


def score(docs: DataFrame, weights: np.ndarray, bias: float, s: Settings = Settings()) -> DataFrame:
    """(doc_id, score): the highest probability among the windows of the whole text.

    Null and empty texts get the probability of the bias alone; null ids and repeated rows stay; no
    rows give no rows. The model is ``s.buckets`` floats whatever the corpus, and travels with the task.
    """

    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column(b.schema.get_field_index("text")).to_pylist()]
            odds = np.concatenate([odds_of(block, weights, bias, s) for block in blocks(texts)] or [np.zeros(0)])
            found = pa.array(1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500))), pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")), found], ["doc_id", "score"])

    slim = docs.select("doc_id", "text")
    return slim.mapInArrow(run, f"doc_id {dict(slim.dtypes)['doc_id']}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Fit on the labelled sample and score all documents: (doc_id, held_out, score, predicted)."""
    sample = label_sample(docs, labels, "toxic", {1: s.toxic_rows, 0: s.clean_rows}, s.longest, s.seed)
    weights, bias = fit(sample, s)
    return score(docs, weights, bias, s).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
