"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from tickspark.operators import reports  # noqa: E402
from tickspark.plans.queries import QUERIES  # noqa: E402
from tickspark.session import local_session  # noqa: E402

HEADLINE = (
    "batch_summary",
    "partial_final_agg",
    "sliding_window_summary",
    "top_k_trades_per_window",
    "rolling_last_n_snapshot",
    "throughput_per_minute",
    "latency_by_rate",
    "merged_view",
    "recent_summary",
    "dedup_by_trade_id",
    "throttle_min_gap",
    "hysteresis_alerts",
)
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def run(frame) -> None:
    """Compute every row and column without bringing them to the driver."""
    frame.write.format("noop").mode("overwrite").save()


def measure(names, sf_dir: str, cores: str) -> dict[str, list[float]]:
    """Seconds of every repeat per query, after one warm-up, on ``local[cores]``."""
    spark = local_session("tickspark-bench", cores=cores, shuffle=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in names:
        run(QUERIES[name](spark, sf_dir))
        took[name] = []
        for _ in range(REPEATS):
            started = time.perf_counter()
            run(QUERIES[name](spark, sf_dir))
            took[name].append(time.perf_counter() - started)
    spark.stop()
    return took


def scaling(names, sf_dir: str, widths: list[str]) -> list[dict]:
    """Speedup and efficiency over core counts, computed with the report operators themselves."""
    rows = [
        (name, int(cores), i, 1000 * seconds)
        for cores in widths
        for name, times in measure(names, sf_dir, cores).items()
        for i, seconds in enumerate(times)
    ]
    spark = local_session("tickspark-bench")
    runs = spark.createDataFrame(rows, "name string, workers int, iteration int, time_ms double")
    stats = reports.run_stats(runs, ["name", "workers"])
    table = [r.asDict() for r in reports.relative_to_baseline(stats, ["name"]).orderBy("name", "workers").collect()]
    spark.stop()
    return table


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    took = {name: round(statistics.median(times), 4) for name, times in measure(names, sf_dir, cores).items()}
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(took.values()), 4),
        "unit": "sec",
        "queries": took,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cores,
    }
    if os.environ.get("BENCH_SCALING"):  # for example 1,2,4
        report["scaling"] = scaling(names, sf_dir, os.environ["BENCH_SCALING"].split(","))
    print(json.dumps(report))


if __name__ == "__main__":
    main()
