"""Batch file sinks: JSON and CSV summaries and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..streaming.feeds import MICROS_ISO


def write_json(frame: DataFrame, path: str) -> str:
    """Replace the JSON rows at ``path``."""
    frame.write.mode("overwrite").json(path)
    return path


def _csv_ready(frame: DataFrame) -> DataFrame:
    """CSV holds no arrays or structs, so they are written as JSON text."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return frame.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in frame.schema.fields
        ]
    )


def write_csv(frame: DataFrame, path: str) -> str:
    _csv_ready(frame).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_csv_run(frame: DataFrame, path: str, run: str) -> str:
    """One CSV folder per run; other runs stay."""
    return write_csv(frame, f"{path}/run={run}")


def write_json_arrays(trades: DataFrame, path: str, batch) -> str:
    """One JSON array of trades per line, grouped by the bounded ``batch`` column."""
    lines = trades.groupBy(batch.alias("_batch")).agg(
        F.to_json(F.collect_list(F.struct(*trades.columns)), {"timestampFormat": MICROS_ISO}).alias("value")
    )
    lines.select("value").write.mode("overwrite").text(path)
    return path
