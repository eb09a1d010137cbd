"""The operators of this subpackage as registered queries: (session, folder of the tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from . import ann, bpe, jaccard, mixing, pivots, quality_model, quality_rules, repeats, runs, secrets, sharding, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_toxicity(spark, sf_dir) -> DataFrame:
    """Toxicity of every document, learned from the labels outside the held-out fifth."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_warc(spark, sf_dir) -> DataFrame:
    """Write one record per page, then read the archives back.

    Length and digest of responses are worked out from the payloads as read; revisits, which have none,
    come from headers alone. Each reading pushes its record type down and skips the other's records.
    """
    path = scratch_path(spark, "warc")
    warc.write_pages(table(spark, sf_dir, "pages"), path)
    responses = warc.read_warc(spark, path).filter(F.col("record_type") == "response")
    revisits = warc.read_warc(spark, path, payload=False).filter(F.col("record_type") == "revisit")
    hashed = responses.withColumn("digest", F.sha1("payload"))
    read = hashed.withColumns({"payload_bytes": F.length("payload").cast("long"), "payload_digest": warc.base32(F.col("digest"))})
    columns = [
        warc.page_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of("refers_to").alias("refers_to"),
    ]
    return read.select(*columns).unionByName(revisits.select(*columns))


@query
def op3_ann(spark, sf_dir) -> DataFrame:
    """The 20 nearest vectors, by inner product, of every twentieth vector."""
    return ann.search(table(spark, sf_dir, "embeddings"), every=20, k=20)


@query
def op4_sharding(spark, sf_dir) -> DataFrame:
    """All documents in 40 shards of the same mixture, counts at most one apart."""
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op5_quality(spark, sf_dir) -> DataFrame:
    """Quality of every document, learned from the labels outside the held-out fifth."""
    return quality_model.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_secrets(spark, sf_dir) -> DataFrame:
    """Spans of secrets in every document."""
    found, names = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.concat(*[F.col(n) for n in names[:3]])
    return found.select(
        "doc_id",
        *[F.size(n).cast("long").alias(f"n_{k}") for n, k in zip(names[:3], secrets.KINDS)],
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.concat(base, F.col(names[3]))).alias("spans"),
    )


@query
def op7_mixing(spark, sf_dir) -> DataFrame:
    """Words the mix takes of each document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


@query
def op8_quality_rules(spark, sf_dir) -> DataFrame:
    """Base statistics of every document, and whether it is kept."""
    found, names = quality_rules.judged(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[F.col(n).alias(n.lstrip("_")) for n in names])


@query
def op9_jaccard(spark, sf_dir) -> DataFrame:
    """Near-duplicate component of every document."""
    found = jaccard.near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op10_bpe(spark, sf_dir) -> DataFrame:
    """Round trip of every document through the word BPE."""
    return bpe.digests(table(spark, sf_dir, "documents"))


@query
def op11_periodic_runs(spark, sf_dir) -> DataFrame:
    """Runs of repeated words in every document, a tenth of them with a planted one."""
    found = runs.periodic_runs(runs.with_planted_runs(table(spark, sf_dir, "documents")))
    best = found.withColumn("best", runs.strongest(F.col("runs")))
    listed = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


@query
def op12_suffix_dedup(spark, sf_dir) -> DataFrame:
    """What is left of every document without byte strings of 200 that also start anywhere else."""
    found = repeats.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op13_clusters(spark, sf_dir) -> DataFrame:
    """Forty clusters of the vectors after five rounds, in exact integers."""
    return pivots.clusters(table(spark, sf_dir, "embeddings"))
