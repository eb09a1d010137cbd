"""Readers of stored trades, windows and partial sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.dedup import dedup_by_trade_id, latest_per_key
from ..operators.quality import reject_reason
from ..schema import TRADE_JSON


def scan_trade_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Stored trades as text fields, one row per record of JSON arrays or objects.

    With ``multi_line`` a file is one document, as batch files are written; otherwise each line
    is. Broken documents come back in ``_corrupt_record``; see ``quality.split_rejects``.
    """
    return (
        spark.read.schema(TRADE_JSON)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )


def scan_with_report(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Stored JSON arrays, pretty-printed or not, as (readable records with their file, report per file).

    A file that is cut or malformed is one reject and gives no records; the scan goes on with the others. A
    record with an unreadable number is a reject of its file, the file's other records stay. The report has
    each file's number of records, of rejects, and the reasons.
    """
    scanned = scan_trade_json(spark, path).withColumn("file", F.col("_metadata.file_path"))
    marked = reject_reason(scanned)
    good = marked.filter(F.col("reason").isNull()).drop("reason", "_corrupt_record")
    report = marked.groupBy("file").agg(
        F.count_if(F.col("reason").isNull()).alias("records"),
        F.count_if(F.col("reason").isNotNull()).alias("rejects"),
        F.array_join(F.array_sort(F.collect_set("reason")), ", ").alias("reasons"),
    )
    return good, report


def read_appended(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """All rows appended by micro-batches, with their ``batch_id``. With ``schema``, that of the rows,
    a store nothing was written to yet reads as an empty table."""
    if schema is None:
        return spark.read.option("basePath", path).parquet(path)
    full = StructType([*schema.fields, StructField("batch_id", LongType())])
    store = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not store.getFileSystem(spark._jsc.hadoopConfiguration()).exists(store):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(path)


def read_speed_store(spark: SparkSession, path: str, key=("product", "trade_id"), schema=None) -> DataFrame:
    """Current content of a keyed trade store: the last write of every key."""
    return dedup_by_trade_id(read_appended(spark, path, schema).drop("batch_id"), key)


def scan_window_store(spark: SparkSession, path: str, product: str | None = None) -> DataFrame:
    """Current windows, of one product or all. The product filter prunes directories."""
    rows = read_appended(spark, path)
    if product is not None:
        rows = rows.filter(F.col("product") == product)
    return latest_per_key(rows, ["product", "window_start"], [F.col("batch_id").desc()]).drop("batch_id")


def compact_store(store: DataFrame, path: str, *partitions: str) -> str:
    """Write the current content of a store as one batch of a new store folder."""
    store.write.partitionBy(*partitions).mode("errorifexists").parquet(f"{path}/batch_id=-1")
    return path
