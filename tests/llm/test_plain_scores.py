"""Scores of the two classifiers, and the order of shards, worked out again in plain Python."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import documents, frame
from tickspark.llm import quality_model, sharding, toxicity

M64 = (1 << 64) - 1
ODD = [(7001, "Stop!!! STOP, stop stop x1 R2-D2 (a.b) -- ##### éàü 中文 ok", None, None, None), (7002, "hm hm hm " * 40, None, None, None)]


def quality_of(text, weights, bias, s):
    words = (text or "").split()
    codes = [quality_model.word_codes(w) for w in words]
    found = []
    for column in (0, 1):
        for order in s.orders:
            for i in range(len(words) - order + 1):
                m = codes[i][column] + order
                for k in range(i + 1, i + order):
                    m = (m * 0x9E3779B97F4A7C15 + codes[k][column]) & M64
                    if column:
                        m = (m + (codes[k][0] == codes[k - 1][0])) & M64
                m = ((m ^ (m >> 29)) * 0xBF58476D1CE4E5B9) & M64
                found.append((m >> 32) & ((1 << s.bits) - 1))
    odds = sum(float(weights[b]) for b in found) / math.sqrt(max(len(found), 1)) + bias
    return 1 / (1 + math.exp(-odds))


def toxicity_of(text, weights, bias, s):
    words, now = [], ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            now += c
        elif now:
            if not words or words[-1] != now:
                words.append(now)
            now = ""
    bags = []
    for w in words:
        code, bag = [0, *map(ord, w), 0], []
        for size in s.grams:
            for i in range(len(code) - size + 1):
                h = size
                for c in code[i : i + size]:
                    h = ((h ^ c) * 0x01000193) & 0xFFFFFFFF
                    h ^= h >> 15
                bag.append(h % s.buckets)
        bags.append(bag)
    step, best = s.window // 2, -math.inf
    for k in range(max(1, -(-(len(words) - s.window) // step) + 1)):
        own = [b for bag in bags[k * step : k * step + s.window] for b in bag]
        best = max(best, sum(float(weights[b]) for b in own) / max(len(own), s.least_bag) + bias)
    return 1 / (1 + math.exp(-best))


@pytest.mark.parametrize(
    "module,plain,size",
    [(quality_model, quality_of, 1 << quality_model.Settings().bits), (toxicity, toxicity_of, toxicity.Settings().buckets)],
)
def test_scores_equal_plain_python(spark, module, plain, size):
    rng = np.random.default_rng(8)
    weights = (np.round(rng.normal(size=size) * 4096) / 4096).astype(np.float32)
    rows, s = documents(3) + ODD, module.Settings()
    got = module.score(frame(spark, rows, extra=True), weights, -0.25, s).collect()
    # ids may be null or repeated: scores are compared by id, in order
    order = lambda pairs: sorted(pairs, key=lambda p: (p[0] is None, p[0] or 0, p[1]))
    want = order((r[0], plain(r[1], weights, -0.25, s)) for r in rows)
    found = order((r.doc_id, r.score) for r in got)
    assert [i for i, _ in found] == [i for i, _ in want]
    assert [p for _, p in found] == pytest.approx([p for _, p in want], rel=1e-9, abs=1e-12)


def test_order_of_shards_equals_plain_python(spark):
    rnd = random.Random(2)
    rows = documents(4) + [(3000 + i, f"text {i % 50}", "en", rnd.choice(["s1", "s9"]), 0) for i in range(1500)]
    docs, shards = frame(spark, rows), 40
    keyed = sharding.document_rows(docs).withColumn("h", F.xxhash64(F.lit(7), "doc_id", "text_crc32", "size")).collect()
    total, first = len(keyed), lambda v: (v is not None, v if v is not None else 0)  # nulls come first
    cells = sharding.cell_count(total)
    keys = lambda r: (r.h, first(r.doc_id), r.text_crc32, r["size"])
    strata = collections.defaultdict(list)
    for r in keyed:
        strata[r.source].append(r)
    line = []
    for source, own in strata.items():
        own.sort(key=lambda r: (r.h % cells, keys(r)))
        line += [((k + 0.5) / len(own), (source is not None, source or ""), keys(r), r) for k, r in enumerate(own)]
    line.sort(key=lambda x: x[:3])
    want = collections.Counter()
    for place, (*_, r) in enumerate(line):
        shard = place * shards // total
        want[(r.doc_id, r.source, r["size"], r.text_crc32, shard, place - -(-shard * total // shards))] += 1
    got = sharding.shard_documents(docs, shards).select("doc_id", "source", "size", "text_crc32", "shard", "slot").collect()
    assert collections.Counter(map(tuple, got)) == want
    assert zlib.crc32(b"text 1") in {r.text_crc32 for r in got}
