"""The pipeline's stages in a row, and the registration."""

import collections
import re

import corpus_pipeline
import public_tokenizers
import tokenizers
from __spark_entry__ import queries
from tests.llm.test_operators import base_spans, brute_groups, statistics

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(size, weights=(5, 2, 1), most=3):
    """Words wanted of each source: by weight, at most three times what there is, the rest shared again."""
    names = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, target, free = float(sum(size.values())), {}, set(names)
    while free:
        part = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if part[s] > most * size[s]}
        if not full:
            return {**target, **part}
        for s in full:
            target[s] = most * size[s]
            left -= target[s]
        free -= full
    return target


def test_queries_are_registered():
    names = set(queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


def test_stages(spark, sf_dir, folder):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        rows = docs.collect()
        kept.append(len(rows))
        if k < 4:
            assert docs.columns == columns and all(r.doc_id in before for r in rows)
        if name == "quality_rules":
            for r in rows:
                n, _, _, _, again = statistics(r.text)
                assert n >= 50 and 100 * again <= 50 * n
        elif name == "ngram_jaccard_join":
            want = {i for i, n, c in brute_groups([tuple(r) for r in before.values()]) if i == c or n == 0}
            assert collections.Counter(r.doc_id for r in rows) == collections.Counter(want)
        elif name == "secret_scans":
            assert len(rows) == len(before)
            changed = {r.doc_id for r in rows if r.text != before[r.doc_id].text}
            assert changed >= {i for i, r in before.items() if base_spans(r.text or "")}
        elif name == "mixing":
            copies = collections.Counter(r.doc_id for r in rows)
            assert max(copies.values()) <= 3
            taken, size, most = collections.Counter(), collections.Counter(), collections.Counter()
            for r in before.values():
                n = len(WORD.findall(r.text or ""))
                size[r.source] += n
                taken[r.source] += copies[r.doc_id] * n
                most[r.source] = max(most[r.source], n)
            for source, target in plain_targets(size).items():
                assert abs(taken[source] - target) <= most[source]
        else:
            assert docs.columns == ["doc_id", "ids"] and min(len(r.ids) for r in rows) > 0
            wanted = [before[r.doc_id].text for r in rows]
            library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            library.no_padding(), library.no_truncation()
            assert [r.ids for r in rows] == [e.ids for e in library.encode_batch(wanted, add_special_tokens=False)]
    assert min(kept) > 0


def test_run_is_the_stages_in_a_row(spark, sf_dir):
    first = collections.Counter(r.doc_id for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").collect())
    again = collections.Counter(r.doc_id for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").collect())
    assert first == again and first
