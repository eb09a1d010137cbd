"""Run statistics, speedups, series summaries and trend lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.tiers import speedup_tier, throughput_tier


def run_stats(
    runs: DataFrame,
    config: list[str],
    time: str = "time_ms",
    order: str = "iteration",
    keep_times: bool = True,
) -> DataFrame:
    """Mean, least and greatest time per configuration, with its times in run order.

    The list of times suits configurations repeated a handful of times; for logs in which one may
    repeat without limit, leave it out with ``keep_times=False``.
    """
    figures = [
        F.count(F.lit(1)).alias("runs"),
        F.avg(time).alias("avg_ms"),
        F.min(time).alias("min_ms"),
        F.max(time).alias("max_ms"),
    ]
    if not keep_times:
        return runs.groupBy(*config).agg(*figures)
    listed = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(time).alias("t"))))
    found = runs.groupBy(*config).agg(*figures, listed.alias("_listed"))
    return found.withColumn("times", F.col("_listed.t")).drop("_listed")


def relative_to_baseline(stats: DataFrame, group: list[str], workers: str = "workers", time: str = "avg_ms"):
    """Speedup and efficiency of each run against the group's run with the fewest workers."""
    by_workers = Window.partitionBy(*group).orderBy(workers)
    base = F.first(time).over(by_workers)
    speedup = F.when(F.col(time) > 0, base / F.col(time)).otherwise(F.lit(1.0))
    with_speed = stats.withColumn("speedup", speedup)
    efficiency = F.when(F.col(workers) > 0, F.col("speedup") / F.col(workers) * 100).otherwise(F.lit(0.0))
    return with_speed.select(
        *group, workers, "speedup", efficiency.alias("efficiency"), F.col(time).alias("time_ms")
    )


def best_parallel(stats: DataFrame, group: list[str], workers: str = "workers", time: str = "avg_ms"):
    """The fastest run with more than one worker, and its speedup over the one-worker run."""
    parallel = F.col(workers) > 1
    fastest = F.min(F.when(parallel, F.struct(F.col(time).alias("t"), F.col(workers).alias("w"))))
    sequential = F.min(F.when(~parallel, F.col(time)))
    return (
        stats.groupBy(*group)
        .agg(fastest.alias("_best"), sequential.alias("sequential_ms"))
        .select(
            *group,
            "sequential_ms",
            F.col("_best.w").alias("best_workers"),
            F.col("_best.t").alias("best_ms"),
            F.when(F.col("_best.t") > 0, F.col("sequential_ms") / F.col("_best.t"))
            .otherwise(F.lit(0.0))
            .alias("speedup"),
        )
    )


def series_summary(throughput: DataFrame, latency: DataFrame, speedups: DataFrame) -> DataFrame:
    """One row of headline figures over the three series."""

    def one(frame: DataFrame, agg):
        return frame.select(agg).scalar()

    return throughput.agg(
        F.max("trades_per_minute").alias("peak_throughput"),
        F.avg("trades_per_minute").alias("avg_throughput"),
        F.sum("trades_per_minute").alias("total_trades"),
    ).select(
        "*",
        one(latency, F.avg("avg_latency")).alias("avg_latency"),
        one(speedups, F.max("speedup")).alias("best_speedup"),
        one(speedups, F.max("efficiency")).alias("best_efficiency"),
        one(speedups, F.min("time_ms")).alias("fastest_time"),
    )


def trend_line(series: DataFrame, group: list[str], order: str, value: str) -> DataFrame:
    """Least-squares line per group over the position in ``order``, with the fitted values.

    ``series`` is already one row per period, so a group has as many rows as there were periods.
    """
    placed = series.withColumn(
        "idx", F.row_number().over(Window.partitionBy(*group).orderBy(order)) - F.lit(1)
    )
    line = placed.groupBy(*group).agg(
        F.regr_slope(value, "idx").alias("slope"), F.regr_intercept(value, "idx").alias("intercept")
    )
    return placed.join(line, group).withColumn("fitted", F.col("intercept") + F.col("slope") * F.col("idx"))


def scaling_tier(summary: DataFrame, speedup: str = "best_speedup", throughput: str = "peak_throughput"):
    """Verdicts for the best speedup and the peak throughput."""
    return summary.withColumn("scaling_tier", speedup_tier(F.col(speedup))).withColumn(
        "throughput_tier", throughput_tier(F.col(throughput))
    )


def report_rows(results: DataFrame, speedups: DataFrame, summary: DataFrame) -> DataFrame:
    """The report as rows (section, record as JSON), for tables of any length: nothing is gathered."""
    parts = (("results", results), ("speedup", speedups), ("summary", summary))
    rows = [t.select(F.lit(name).alias("section"), F.to_json(F.struct(*t.columns)).alias("record")) for name, t in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def report_document(results: DataFrame, speedups: DataFrame, summary: DataFrame) -> DataFrame:
    """One nested report row: run results, speedups and the headline figures.

    Inputs are report tables of a few configurations; ``report_rows`` takes any number.
    """

    def rows(frame: DataFrame):
        return frame.select(F.array_sort(F.collect_list(F.struct(*frame.columns)))).scalar()

    return summary.select(
        rows(results).alias("results"),
        rows(speedups).alias("speedup"),
        F.struct(*[F.col(c) for c in summary.columns]).alias("summary"),
    )
