"""Rows alike in id and text but not in source keep their own copies and shards."""

import collections

from pyspark.sql import functions as F

from tests.llm.data import documents, frame
from tickspark.llm import mixing, sharding

ROWS = documents()


def counted(rows):
    return collections.Counter(rows)


def test_copies_go_to_the_row_of_their_source(spark):
    text = "one two three four five"
    rows = [(i, text + f" {i}", "en", "A", 0) for i in range(2, 40)]
    rows += [(i, text + f" {i}", "en", "B", 0) for i in range(40, 400)] + [(1, text, "en", "A", 0), (1, text, "en", "B", 0), (1, text, "en", None, 0)]
    docs = frame(spark, rows, extra=True)
    want = collections.Counter()
    for r in mixing.mix(docs).collect():
        want[r.doc_id, r.source] += r.copies
    got = counted((r.doc_id, r.source) for r in mixing.mixed_documents(docs).collect())
    assert got == +want
    share = {r.source: r.target / r.source_size for r in mixing.mix(docs).collect()}
    for source, part in share.items():
        assert abs(got[1, source] - part) <= 1


def test_shards_on_disk_with_a_shard_column_and_rows_alike(spark, folder):
    rows = ROWS[:60] + [ROWS[2]] * 3 + [(7000, "same text", "en", s, 9) for s in ("s1", "s2", None)]
    docs = frame(spark, rows).withColumn("shard", F.lit("mine")).withColumn("_shard", F.lit(5))
    sharding.write_shards(docs, f"{folder}/s", 4)
    back = spark.read.parquet(f"{folder}/s")
    assert set(back.columns) == {*docs.columns, "_shard_1"}
    assert {r["_shard_1"] for r in back.collect()} == {"mine"} and {r["_shard"] for r in back.collect()} == {5}
    assert counted((r.doc_id, r.text, r.source) for r in back.collect()) == counted((r[0], r[1], r[3]) for r in rows)
    placed = counted((r.doc_id, r.source, r.shard) for r in sharding.shard_documents(docs, 4).collect())
    assert counted((r.doc_id, r.source, r.shard) for r in back.collect()) == placed
