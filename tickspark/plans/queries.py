"""Every operator as a named query over the given tables: (session, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.numeric import format_money, format_volume, round_half_up
from ..operators import batch, counters, dedup, fleet, holdoff, merged, quality, recent, reports, sketches, windows
from ..schema import BATCH_SUMMARY, EVENT_PRICE_BOUNDS as BOUNDS, TRADE, read_events, read_trades
from ..session import ROCKSDB_PROVIDER, scratch_path
from ..sinks import appended, files, versions
from ..sources import catalog, feed, shards, stores
from ..streaming import batches, feeds, flows, flush, state

# Parameters of the registered queries, sized to the event rate of the given tables.
HOUR, DAY = 3600, 86_400
SNAPSHOT_N = 10
SLIDE = 600
THROTTLE_SECONDS = 300
FLUSH_ROWS = 5_000  # the stock 100 rows per file would drown large tables in files
POLL_ROWS = 4_000  # records a poll takes from a shard; the stock 100 would need many polls over large tables
SHARD_ROWS = 200
POLLS = 256  # polls that a micro-batch takes at most when the stream is behind
SEGMENT_ROWS = 25 * POLL_ROWS
FLUSH_BATCH, FLUSH_HOURS = 20, 6  # so that the given event rate closes batches by count and by time
ALERTS = fleet.AlertRule(
    high=60.0, low=45.0, min_level=1, max_level=3, hold=7200.0, cooldown=10800.0, up_delay=16.0, down_delay=1.0
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(spark, sf_dir)

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return run


def iso(column) -> Column:
    return F.date_format(column, feeds.MICROS_ISO)


def nth(value: int) -> Column:
    return F.col("trade_id") % value == 0


def hourly_windows(spark, sf_dir) -> DataFrame:
    return windows.sliding_window_summary(read_trades(spark, sf_dir), HOUR, SLIDE)


def event_summary(spark, sf_dir) -> DataFrame:
    return batch.batch_summary(read_trades(spark, sf_dir), BOUNDS)


def normal_trades(spark, sf_dir) -> DataFrame:
    return batch.valid_trades(read_trades(spark, sf_dir), BOUNDS)


def rewritten(trades: DataFrame) -> DataFrame:
    """Trades sharing ids three by three, so that a keyed store sees rewrites."""
    return trades.withColumn("trade_id", F.floor(F.col("trade_id") / 3).cast("long"))


def event_stream(spark, sf_dir) -> DataFrame:
    return feeds.stream_events(spark, f"{sf_dir}/events.parquet")


def stored(spark, stream: DataFrame) -> DataFrame:
    """Run a stream to its end and read what it wrote."""
    out = scratch_path(spark, "stream-out")
    feeds.run_available(spark, stream.writeStream.format("parquet").outputMode("append").option("path", out))
    return spark.read.schema(stream.schema).parquet(out)


def closed(spark, sf_dir, flow, span: int) -> DataFrame:
    """Run a stream of all trades to its end, let ``span`` seconds and the usual delay pass, read what it wrote."""
    last = read_trades(spark, sf_dir).agg(F.max("time")).first()[0]
    stream, out = event_stream(spark, sf_dir), scratch_path(spark, "stream-out")
    start = lambda m: flow(stream, m).writeStream.format("parquet").outputMode("append").option("path", out)
    if last is not None:
        feeds.run_and_close(spark, start, last + timedelta(seconds=span + DAY))
    return spark.read.schema(flow(stream, None).schema).parquet(out)


def run_polls(spark, rows: DataFrame, start, limit: int = POLL_ROWS) -> None:
    """Write numbered rows as shards and run a stream over them from their first record, ``limit`` a poll and shard.

    ``start`` gets the trades with the poll they came with.
    """
    path = shards.write_shards(rows, scratch_path(spark, "shards"), SEGMENT_ROWS)
    stream = shards.stream_shards(spark, path, TRADE, scratch_path(spark, "progress"), "earliest", limit, SEGMENT_ROWS, POLLS)
    writer = start(stream.drop("shard", "number"))
    feeds.run_drained(writer.option("checkpointLocation", scratch_path(spark, "stream")))


def one_shard(spark, sf_dir) -> DataFrame:
    """All trades in one shard, so that polls come in order of time."""
    return shards.numbered(read_trades(spark, sf_dir), F.lit(0), "time", "trade_id")


def late_windows(spark, sf_dir) -> str:
    """Run windows over two shards of which one has a tenth of the trades: its clock runs ahead of the other's."""
    rows = shards.numbered(read_trades(spark, sf_dir), F.when(nth(10), 0).otherwise(1), "time", "trade_id")
    out = scratch_path(spark, "late-windows")
    run_polls(spark, rows, lambda s: s.writeStream.foreachBatch(batches.put_windows_and_late(out, HOUR, SLIDE, DAY)))
    return out


def stateful(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


# ---- sources ----------------------------------------------------------------------------------


@query
def parse_matches(spark, sf_dir):
    trades = read_trades(spark, sf_dir)
    message = F.struct(
        F.when(nth(5), "subscriptions").otherwise("match").alias("type"),
        iso("time").alias("time"),
        F.col("product").alias("product_id"),
        F.col("price").cast("string").alias("price"),
        F.col("size").cast("string").alias("size"),
        "side",
        "trade_id",
    )
    raw = trades.select(F.to_json(message).alias("raw"), "processed_at")
    return feed.parse_matches(raw, received_at=F.col("processed_at"))


@query
def scan_json_arrays(spark, sf_dir):
    path = files.write_json_arrays(
        read_trades(spark, sf_dir), scratch_path(spark, "raw-batch"), F.floor(F.col("trade_id") / 100)
    )
    good, _ = quality.split_rejects(stores.scan_trade_json(spark, path, multi_line=False))
    return quality.type_trades(good)


ARRAY_ROWS = 500  # records of one array file


def broken_arrays(spark, sf_dir) -> str:
    """Pretty-printed arrays, a file each; every seventh is cut in half."""
    record = F.struct("trade_id", iso("time").alias("time"), "product", "price", "size", "side", iso("processed_at").alias("processed_at"), "latency_ms")
    number = F.floor(F.col("trade_id") / ARRAY_ROWS).cast("long").alias("file_no")
    arrays = read_trades(spark, sf_dir).groupBy(number).agg(
        F.to_json(F.array_sort(F.collect_list(record)), {"pretty": "true"}).alias("text")
    )
    half = F.expr("substring(text, 1, length(text) div 2)")
    path = scratch_path(spark, "arrays")
    cut = arrays.withColumn("text", F.when(F.col("file_no") % 7 == 3, half).otherwise(F.col("text")))
    cut.write.partitionBy("file_no").text(path)
    return path


@query
def scan_broken_arrays(spark, sf_dir):
    """The records of all whole files."""
    good, _ = stores.scan_with_report(spark, broken_arrays(spark, sf_dir))
    return quality.type_trades(good)


@query
def scan_reject_report(spark, sf_dir):
    """What each file had, and why some had nothing."""
    _, report = stores.scan_with_report(spark, broken_arrays(spark, sf_dir))
    number = F.regexp_extract("file", "file_no=([0-9]+)", 1).cast("long").alias("file_no")
    return report.select(number, "records", "rejects", "reasons")


@query
def scan_speed_store(spark, sf_dir):
    newest = recent.scan_speed_store(read_trades(spark, sf_dir), limit=200)
    return newest.select("trade_id", "time", "product", "price", "size", "side")


@query
def scan_window_store(spark, sf_dir):
    path = scratch_path(spark, "window-store")
    appended.put_windows(path)(hourly_windows(spark, sf_dir), 0)
    return stores.scan_window_store(spark, path, "click")


@query
def lookup_batch_summary(spark, sf_dir):
    return merged.lookup_batch_summary(event_summary(spark, sf_dir), "click")


@query
def stream_trades(spark, sf_dir):
    return stored(spark, event_stream(spark, sf_dir))


@query
def sql_catalog(spark, sf_dir):
    catalog.register_views(read_trades(spark, sf_dir))
    return spark.sql(
        """
        SELECT product, side, count(*) AS trade_count,
               coalesce(cast(sum(cast(size AS decimal(38,8))) AS double), 0) AS total_volume
        FROM trades GROUP BY product, side
        """
    )


# ---- sinks ------------------------------------------------------------------------------------


@query
def sink_keyed_stream(spark, sf_dir):
    out = scratch_path(spark, "keyed")
    feeds.run_available(spark, feeds.publish_keyed_files(event_stream(spark, sf_dir), out))
    messages = spark.read.schema("value string, product string").json(out)
    body = F.from_json("value", TRADE, {"timestampFormat": feeds.MICROS_ISO})
    keyed = messages.select(F.col("product").alias("key"), body.alias("m"))
    return keyed.filter(F.col("key").eqNullSafe(F.col("m.product"))).select("m.*")


@query
def sink_raw_batches(spark, sf_dir):
    out = scratch_path(spark, "raw")
    feeds.run_available(spark, feeds.raw_batches(event_stream(spark, sf_dir), out, FLUSH_ROWS))
    good, _ = quality.split_rejects(stores.scan_trade_json(spark, out, multi_line=False))
    return quality.type_trades(good)


@query
def sink_speed_upsert(spark, sf_dir):
    out = scratch_path(spark, "speed-store")
    writes = rewritten(event_stream(spark, sf_dir))
    feeds.run_available(spark, writes.writeStream.foreachBatch(appended.upsert_trades(out)))
    return stores.read_speed_store(spark, out).select("product", "trade_id", "price", "size", "processed_at")


@query
def sink_merged_store(spark, sf_dir):
    """The keyed store after polls of which every second one is followed by a merge."""
    out = scratch_path(spark, "merged-store")
    start = lambda s: rewritten(s.drop("poll")).writeStream.foreachBatch(versions.upsert_and_merge(out, TRADE, every=2))
    run_polls(spark, one_shard(spark, sf_dir), start)
    return versions.read_store(spark, out, TRADE).select("product", "trade_id", "price", "size", "processed_at")


@query
def sink_window_summary(spark, sf_dir):
    out = scratch_path(spark, "windows")
    stream = flows.stream_sliding_windows(event_stream(spark, sf_dir), HOUR, SLIDE)
    writer = stream.writeStream.outputMode("update").foreachBatch(appended.put_windows(out))
    feeds.run_available(spark, writer)
    return stores.scan_window_store(spark, out)


@query
def sink_batch_json(spark, sf_dir):
    path = files.write_json(event_summary(spark, sf_dir), scratch_path(spark, "summary-json"))
    return spark.read.schema(BATCH_SUMMARY).json(path)


@query
def sink_batch_csv(spark, sf_dir):
    path = scratch_path(spark, "summary-csv")
    files.write_csv_run(event_summary(spark, sf_dir), path, "2024-01-31_00-00-00")
    return spark.read.schema(BATCH_SUMMARY).option("header", True).csv(f"{path}/run=*")


@query
def sink_report_csv(spark, sf_dir):
    path = files.write_csv(run_table(spark, sf_dir), scratch_path(spark, "report-csv"))
    text = spark.read.option("header", True).csv(path)
    times = F.from_json("times", "array<double>")
    return text.select(
        "name",
        F.col("workers").cast("int").alias("workers"),
        round_half_up(F.col("avg_ms").cast("double"), 6).alias("avg_ms"),
        F.size(times).cast("long").alias("runs"),
        round_half_up(F.array_max(times), 6).alias("max_ms"),
        round_half_up(F.col("min_ms").cast("double"), 6).alias("min_ms"),
        F.array_join(F.transform(times, lambda t: F.format_string("%.6f", t)), " ").alias("times"),
    )


@query
def sink_report_json(spark, sf_dir):
    results = run_table(spark, sf_dir)
    speedups = speedup_table(spark, sf_dir)
    summary = speedups.agg(
        F.max("speedup").alias("best_speedup"),
        F.max("efficiency").alias("best_efficiency"),
        F.min("time_ms").alias("fastest_time"),
    )
    report = reports.report_document(results, speedups, summary)
    path = files.write_json(report, scratch_path(spark, "report-json"))
    back = spark.read.schema(report.schema).json(path)
    shown = F.transform(
        "results", lambda r: F.concat_ws(":", r["name"], r["workers"].cast("string"), F.format_string("%.6f", r["avg_ms"]))
    )
    return back.select(
        F.array_join(F.array_sort(shown), " ").alias("results"),
        F.size("results").cast("long").alias("result_rows"),
        F.size("speedup").cast("long").alias("speedup_rows"),
        *[
            round_half_up(F.col(f"summary.{c}"), 6).alias(c)
            for c in ("best_speedup", "best_efficiency", "fastest_time")
        ],
    )


# ---- projections and filters ------------------------------------------------------------------


@query
def price_sanity_filter(spark, sf_dir):
    return quality.price_sanity_filter(read_trades(spark, sf_dir), BOUNDS).select("trade_id", "product", "price")


@query
def sanity_counters(spark, sf_dir):
    return quality.sanity_counters(read_trades(spark, sf_dir), BOUNDS)


@query
def normalize_trades(spark, sf_dir):
    columns = ("trade_id", "product", "price", "size", "side", "latency_ms")
    return quality.normalize_trades(read_trades(spark, sf_dir)).select(*columns)


@query
def require_product(spark, sf_dir):
    gaps = F.when(nth(10), "").when(~nth(7), F.col("product"))
    return quality.require_product(read_trades(spark, sf_dir).withColumn("product", gaps)).select(
        "trade_id", "product"
    )


@query
def recent_trades(spark, sf_dir):
    text = F.when(nth(50), "junk").otherwise(iso("processed_at"))
    rows = read_trades(spark, sf_dir).withColumn("processed_at", text)
    return recent.recent_trades(rows, seconds=DAY).select("trade_id", "product", "processed_at")


@query
def recent_or_last_n(spark, sf_dir):
    return recent.recent_or_last_n(read_trades(spark, sf_dir)).select("trade_id", "product", "price", "size")


@query
def sql_conjunct_filter(spark, sf_dir):
    trades = read_trades(spark, sf_dir)
    since = recent.as_of_column(trades, None) - F.expr("INTERVAL 5 DAYS")
    return catalog.sql_conjunct_filter(trades, "click", since).select("trade_id", "product", "price")


@query
def event_time_fallback(spark, sf_dir):
    rows = read_trades(spark, sf_dir).withColumns(
        {"processed_at": F.when(~nth(7), F.col("processed_at")), "time": F.when(~nth(14), F.col("time"))}
    )
    return quality.event_time_fallback(rows).select("trade_id", "event_time")


@query
def latency_per_trade(spark, sf_dir):
    return recent.latency_per_trade(read_trades(spark, sf_dir)).select("trade_id", "latency")


@query
def stamp_processed(spark, sf_dir):
    at = F.col("time") + F.expr("INTERVAL 1 SECOND")
    return quality.stamp_processed(read_trades(spark, sf_dir), at).select("trade_id", "processed_at")


@query
def default_fill(spark, sf_dir):
    sparse = hourly_windows(spark, sf_dir).withColumn(
        "avg_price", F.when(F.col("trade_count") > 1, F.col("avg_price"))
    )
    return merged.default_fill(sparse)


@query
def safe_number_format(spark, sf_dir):
    text = F.when(nth(9), "n/a").otherwise(F.col("price").cast("string"))
    return read_trades(spark, sf_dir).select(
        "trade_id", format_money(text).alias("money"), format_volume(F.col("size")).alias("volume")
    )


# ---- joins ------------------------------------------------------------------------------------


def recent_figures(spark, sf_dir) -> DataFrame:
    return recent.recent_summary(recent.recent_or_last_n(read_trades(spark, sf_dir), seconds=DAY))


def window_text(w) -> Column:
    """All figures of a window as text, prices in cents and volumes in ten thousandths."""
    figures = [F.unix_seconds(w["window_start"]), w["trade_count"], w["buy_count"], w["sell_count"]]
    figures += [F.floor(w[c] * 100 + 0.5) for c in ("avg_price", "max_price", "min_price")]
    figures += [F.floor(w["total_volume"] * 10_000 + 0.5)]
    return F.concat_ws(":", *[x.cast("string") for x in figures])


@query
def merged_view(spark, sf_dir):
    nested = merged.merged_view(
        recent_figures(spark, sf_dir), event_summary(spark, sf_dir), hourly_windows(spark, sf_dir)
    )
    return nested.select(
        "product",
        *[F.col(f"speed_layer.{c}").alias(f"speed_{c}") for c in merged.SPEED_NAMES],
        *[F.col(f"batch_layer.{c}").alias(f"batch_{c}") for c in merged.BATCH_NAMES.values()],
        F.col("batch_layer.status").alias("status"),
        F.size("window_metrics").cast("long").alias("window_rows"),
        F.col("window_metrics")[0]["window_start"].alias("newest_window"),
        F.col("window_metrics")[0]["trade_count"].alias("newest_count"),
        F.array_join(F.transform("window_metrics", window_text), " ").alias("windows"),
    )


@query
def batch_lookup_or_zero(spark, sf_dir):
    known = read_trades(spark, sf_dir).select("product")
    wanted = known.union(spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_name").alias("product")))
    return merged.batch_lookup_or_zero(wanted, event_summary(spark, sf_dir))


@query
def latency_by_rate(spark, sf_dir):
    found = recent.latency_by_rate(read_trades(spark, sf_dir), unit="HOUR")
    means = ("avg_latency", "p95_latency", "p99_latency")
    return found.select("rate_bucket", "samples", *[round_half_up(F.col(c), 6).alias(c) for c in means])


def run_rows(spark, sf_dir) -> DataFrame:
    """Five runs per (product, workers): a run's time is the mean price of its share of the trades."""
    n = F.col("trade_id")
    return (
        read_trades(spark, sf_dir)
        .groupBy(
            F.col("product").alias("name"),
            F.element_at(F.array(*[F.lit(w) for w in (1, 2, 4, 8)]), (n % 4 + 1).cast("int")).alias("workers"),
            (F.floor(n / 4) % 5).cast("long").alias("iteration"),
        )
        .agg(recent.exact_avg("price").alias("time_ms"))
    )


def run_table(spark, sf_dir) -> DataFrame:
    return reports.run_stats(run_rows(spark, sf_dir), ["name", "workers"])


def speedup_table(spark, sf_dir) -> DataFrame:
    return reports.relative_to_baseline(run_table(spark, sf_dir), ["name"])


@query
def relative_to_baseline(spark, sf_dir):
    figures = ("speedup", "efficiency", "time_ms")
    return speedup_table(spark, sf_dir).select(
        "name", "workers", *[round_half_up(F.col(c), 6).alias(c) for c in figures]
    )


@query
def speed_vs_batch_delta(spark, sf_dir):
    flat = merged.merged_flat(recent_figures(spark, sf_dir), event_summary(spark, sf_dir))
    deltas = merged.speed_vs_batch_delta(flat)
    exact = [c for c in deltas.columns if not c.endswith("_delta") or c == "trades_delta"]
    return deltas.select(*exact, *[round_half_up(F.col(c), 6).alias(c) for c in deltas.columns if c not in exact])


# ---- aggregations -----------------------------------------------------------------------------


@query
def batch_summary(spark, sf_dir):
    return event_summary(spark, sf_dir)


@query
def metric_pairs(spark, sf_dir):
    pairs = batch.metric_pairs(normal_trades(spark, sf_dir))
    return pairs.groupBy("product", "metric").agg(F.count(F.lit(1)).alias("pairs"))


@query
def reduce_by_metric(spark, sf_dir):
    return batch.reduce_by_metric(normal_trades(spark, sf_dir))


@query
def reduce_pairs(spark, sf_dir):
    return batch.reduce_pairs(batch.metric_pairs(normal_trades(spark, sf_dir)))


@query
def pivot_metrics(spark, sf_dir):
    return batch.pivot_metrics(batch.reduce_by_metric(normal_trades(spark, sf_dir)))


@query
def avg_latency_by_product(spark, sf_dir):
    return batch.avg_latency_by_product(normal_trades(spark, sf_dir))


@query
def product_stats_raw(spark, sf_dir):
    return batch.product_stats_raw(read_trades(spark, sf_dir))


@query
def product_sums(spark, sf_dir):
    return batch.product_sums(read_trades(spark, sf_dir))


@query
def partial_final_agg(spark, sf_dir):
    return batch.rollup_summary(batch.daily_partials(read_trades(spark, sf_dir), BOUNDS))


@query
def recent_summary(spark, sf_dir):
    return recent_figures(spark, sf_dir)


@query
def throughput_per_minute(spark, sf_dir):
    return recent.throughput_per_minute(read_trades(spark, sf_dir))


@query
def throughput_last_minutes(spark, sf_dir):
    return recent.throughput_per_minute(read_trades(spark, sf_dir), take="last")


@query
def minute_of_day_history(spark, sf_dir):
    return recent.minute_of_day_history(read_trades(spark, sf_dir))


@query
def sql_recent_totals(spark, sf_dir):
    catalog.register_views(read_trades(spark, sf_dir))
    return catalog.recent_totals(spark, catalog.newest(), minutes=1440)


@query
def sql_recent_count(spark, sf_dir):
    catalog.register_views(read_trades(spark, sf_dir))
    return catalog.recent_count(spark, catalog.newest(), minutes=7200, product="click")


@query
def latency_avg_p95(spark, sf_dir):
    found = recent.latency_tail(read_trades(spark, sf_dir), seconds=5 * DAY)
    return found.select(*[round_half_up(F.col(c), 6).alias(c) for c in ("avg_latency", "p95_latency")])


@query
def latency_sketch_rollup(spark, sf_dir):
    """Latency percentiles per product from sketches that micro-batches stored per day."""
    out = scratch_path(spark, "sketches")
    feeds.run_available(spark, event_stream(spark, sf_dir).writeStream.foreachBatch(appended.put_sketches(out)))
    found = sketches.sketched_percentiles(sketches.merge_sketches(stores.read_appended(spark, out), "product"))
    return found.select(
        "product", "samples", "max_latency", *[round_half_up(F.col(c), 6).alias(c) for c in ("avg_latency", *sketches.TAILS)]
    )


@query
def latency_sketch_error(spark, sf_dir):
    """Whether the percentiles of small sketches, merged over days, have the rank their error bound allows."""
    trades, k = read_trades(spark, sf_dir), 200
    merged = sketches.merge_sketches(sketches.latency_sketches(trades, k), "product", k=k)
    errors = sketches.rank_errors(trades, sketches.sketched_percentiles(merged))
    # the bound holds at 99 % confidence; three times it practically always
    within = [(F.col(c) <= 3 * sketches.rank_error(k)).alias(f"{c}_within") for c in sketches.TAILS]
    return errors.select("product", "samples", *within)


@query
def latency_pool_avg(spark, sf_dir):
    return recent.latency_pool_avg(read_trades(spark, sf_dir))


@query
def run_stats(spark, sf_dir):
    shown = F.transform("times", lambda t: F.format_string("%.6f", t))
    return run_table(spark, sf_dir).select(
        "name",
        "workers",
        "runs",
        *[round_half_up(F.col(c), 6).alias(c) for c in ("avg_ms", "min_ms", "max_ms")],
        F.array_join(shown, " ").alias("times"),
    )


def summary_row(spark, sf_dir) -> DataFrame:
    trades = read_trades(spark, sf_dir)
    found = reports.series_summary(
        recent.throughput_per_minute(trades, take=None, unit="HOUR"),
        recent.latency_by_rate(trades, unit="HOUR"),
        speedup_table(spark, sf_dir),
    )
    counts = ("peak_throughput", "total_trades")
    return found.select(
        *[F.col(c) if c in counts else round_half_up(F.col(c), 6).alias(c) for c in found.columns]
    )


@query
def series_summary(spark, sf_dir):
    return summary_row(spark, sf_dir)


@query
def scaling_tier(spark, sf_dir):
    return reports.scaling_tier(summary_row(spark, sf_dir)).select(
        "best_speedup", "peak_throughput", "scaling_tier", "throughput_tier"
    )


@query
def trend_line(spark, sf_dir):
    daily = (
        read_trades(spark, sf_dir)
        .groupBy("product", F.date_trunc("DAY", "time").alias("day"))
        .agg(F.count(F.lit(1)).alias("trades"))
    )
    found = reports.trend_line(daily, ["product"], "day", "trades")
    figures = ("slope", "intercept", "fitted")
    return found.select("product", "day", "trades", *[round_half_up(F.col(c), 6).alias(c) for c in figures])


@query
def best_parallel(spark, sf_dir):
    found = reports.best_parallel(run_table(spark, sf_dir), ["name"])
    figures = ("sequential_ms", "best_ms", "speedup")
    return found.select("name", "best_workers", *[round_half_up(F.col(c), 6).alias(c) for c in figures])


def fleet_ticks(spark, sf_dir) -> DataFrame:
    """Hourly fleet averages: a product is a fleet of seven instances, some samples are missing."""
    samples = read_trades(spark, sf_dir).select(
        F.col("product").alias("fleet"),
        (F.col("trade_id") % 7).alias("instance_id"),
        F.col("time").alias("ts"),
        F.when(~nth(9), F.col("price")).alias("cpu"),
    )
    return fleet.fleet_average(samples, HOUR)


@query
def fleet_average(spark, sf_dir):
    return fleet_ticks(spark, sf_dir)


@query
def batch_counters(spark, sf_dir):
    return batch.batch_counters(read_trades(spark, sf_dir), BOUNDS)


@query
def observed_counters(spark, sf_dir):
    """The same counters, seen while the summary is computed and written."""
    summary, seen = counters.observed_summary(read_trades(spark, sf_dir), BOUNDS)
    summary.write.parquet(scratch_path(spark, "summary"))
    return read_events(spark, sf_dir).limit(1).select(*[F.lit(v).alias(k) for k, v in seen.get.items()])


@query
def stream_observed_counters(spark, sf_dir):
    """Counters of all micro-batches, from a listener to the stream that stores partial sums."""
    out, log = scratch_path(spark, "observed"), counters.CounterLog()
    write = lambda b, n: appended.put(batch.product_partials(b), out, n)
    spark.streams.addListener(log)
    try:
        start = lambda s: counters.counted_trades(s.drop("poll"), bounds=BOUNDS).writeStream.foreachBatch(write)
        run_polls(spark, one_shard(spark, sf_dir), start)
        log.ended.wait(60)
    finally:
        spark.streams.removeListener(log)
    return spark.range(1).select(*[F.lit(v).cast("long").alias(n) for n, v in log.totals().items()])


# ---- windows and top-k ------------------------------------------------------------------------


def flat_snapshots(found: DataFrame) -> DataFrame:
    ids = F.transform("top_5_trades", lambda t: t["trade_id"].cast("string"))
    return found.select(
        *[c for c in found.columns if c not in ("top_5_trades", "window_start", "window_end")],
        F.col("window_start").alias("window_start"),
        F.array_join(ids, " ").alias("top_ids"),
    )


@query
def rolling_last_n_snapshot(spark, sf_dir):
    return flat_snapshots(windows.rolling_last_n_snapshot(read_trades(spark, sf_dir), SNAPSHOT_N, HOUR))


@query
def rolling_last_n_default(spark, sf_dir):
    """Snapshots with the stock parameters: 10,000 trades, ten-second slots."""
    found = windows.rolling_last_n_snapshot(read_trades(spark, sf_dir))
    return found.drop("top_5_trades", "window_end")


@query
def slot_first_emission(spark, sf_dir):
    return windows.slot_first_emission(read_trades(spark, sf_dir), HOUR)


@query
def window_label(spark, sf_dir):
    return windows.window_label(read_trades(spark, sf_dir), HOUR)


@query
def sliding_window_summary(spark, sf_dir):
    return hourly_windows(spark, sf_dir)


@query
def sliding_window_default(spark, sf_dir):
    """Sliding windows with the stock parameters: 60 seconds every 10."""
    return windows.sliding_window_summary(read_trades(spark, sf_dir))


@query
def top_k_trades_per_window(spark, sf_dir):
    ranked = windows.top_k_trades_per_window(read_trades(spark, sf_dir), 5, HOUR, SLIDE)
    return ranked.select(
        "window_start", "product", F.col("rank").cast("long").alias("rank"), "trade_id", "price", "size", "side"
    )


@query
def latest_windows(spark, sf_dir):
    newest = windows.latest_windows(hourly_windows(spark, sf_dir))
    return newest.withColumn("recency", F.col("recency").cast("long"))


@query
def window_history(spark, sf_dir):
    points = windows.window_history(hourly_windows(spark, sf_dir))
    return points.withColumn("recency", F.col("recency").cast("long"))


@query
def first_n_by_key(spark, sf_dir):
    return recent.first_n_by_key(read_trades(spark, sf_dir), 500).select("key", "trade_id", "product", "price")


# ---- set operations ---------------------------------------------------------------------------


@query
def union_pages(spark, sf_dir):
    trades = read_trades(spark, sf_dir).select("trade_id", "product", "price", "latency_ms")
    pages = [trades.filter(F.col("trade_id") % 3 == n) for n in range(3)]
    return dedup.union_pages(pages[0], pages[1].drop("latency_ms"), pages[2])


@query
def dedup_by_trade_id(spark, sf_dir):
    return dedup.dedup_by_trade_id(rewritten(read_trades(spark, sf_dir))).select(
        "product", "trade_id", "price", "size", "processed_at"
    )


# ---- streams and state ------------------------------------------------------------------------


@query
def throttle_min_gap(spark, sf_dir):
    kept = holdoff.throttle_min_gap(read_trades(spark, sf_dir), THROTTLE_SECONDS)
    return kept.select("product", "trade_id", "time")


@query
def throttle_all_products(spark, sf_dir):
    kept = holdoff.throttle_min_gap(read_trades(spark, sf_dir), THROTTLE_SECONDS, key=None)
    return kept.select("product", "trade_id", "time")


@query
def stream_throttle(spark, sf_dir):
    stateful(spark)
    kept = stored(spark, state.stream_throttle(event_stream(spark, sf_dir), THROTTLE_SECONDS))
    return kept.select("product", "trade_id", "time")


@query
def stream_throttle_all(spark, sf_dir):
    """One clock for all products, over polls of one shard."""
    out = scratch_path(spark, "throttled")
    write = batches.put_throttled(out, THROTTLE_SECONDS)
    run_polls(spark, one_shard(spark, sf_dir), lambda s: s.drop("poll").writeStream.foreachBatch(write))
    return stores.read_appended(spark, f"{out}/kept", TRADE).select("product", "trade_id", "time")


@query
def stream_sliding_windows(spark, sf_dir):
    return closed(spark, sf_dir, lambda s, m: flows.stream_sliding_windows(s, HOUR, SLIDE, marks=m), HOUR)


@query
def stream_windows_and_late(spark, sf_dir):
    """Windows of a stream whose shards run apart, with the trades that came too late for them."""
    path = late_windows(spark, sf_dir)
    return batches.read_windows(spark, path, HOUR, SLIDE, DAY, closed=True)


@query
def stream_late_rows(spark, sf_dir):
    late = batches.read_late(spark, late_windows(spark, sf_dir), TRADE)
    return late.select("product", "trade_id", "time", "missed")


@query
def stream_shard_polls(spark, sf_dir):
    """Records written after a stream has started at the end of every shard, and the poll each came with."""
    trades = read_trades(spark, sf_dir)
    rows = shards.numbered(trades, F.col("trade_id") % 16, "time", "trade_id")
    half = F.col("number") < F.lit(trades.count() // 32)
    path, progress, out = (scratch_path(spark, n) for n in ("shards", "progress", "polls"))
    checkpoint, found = scratch_path(spark, "stream"), StructType([*TRADE.fields, *shards.PLACE])
    write = lambda b, n: appended.put(b, out, n)
    for part in (rows.filter(half), rows.filter(~half)):  # the second run goes on where the first one stopped
        shards.write_shards(part, path)
        stream = shards.stream_shards(spark, path, TRADE, progress, "latest", SHARD_ROWS, polls=POLLS)
        feeds.run_drained(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint))
    polls = stores.read_appended(spark, out, found)
    first = polls.agg(F.min("poll")).first()[0]
    return polls.select("shard", "number", "trade_id", "price", (F.col("poll") - F.lit(first)).cast("long").alias("poll"))


@query
def stream_rolling_last_n(spark, sf_dir):
    stateful(spark)
    return flat_snapshots(
        stored(spark, state.stream_rolling_last_n(event_stream(spark, sf_dir), SNAPSHOT_N, HOUR))
    )


def enriched(spark, sf_dir) -> str:
    """Run a stream of text records, each twice and some broken, into trades and dead letters."""
    stream = event_stream(spark, sf_dir)
    raw = stream.select(
        F.col("trade_id").cast("string").alias("trade_id"),
        iso("time").alias("time"),
        F.when(~nth(10), F.col("product")).alias("product"),
        F.when(nth(21), "broken").otherwise(F.col("price").cast("string")).alias("price"),
        F.col("size").cast("string").alias("size"),
        "side",
        F.lit(None).cast("string").alias("processed_at"),
        F.col("latency_ms").cast("string").alias("latency_ms"),
        F.lit(None).cast("string").alias("_corrupt_record"),
    )
    out = scratch_path(spark, "enriched")
    write = batches.put_enriched(out, F.col("time") + F.expr("INTERVAL 2 SECONDS"))
    feeds.run_available(spark, raw.union(raw).writeStream.foreachBatch(write))
    return out


@query
def stream_enrich_dedup(spark, sf_dir):
    good = stores.read_appended(spark, f"{enriched(spark, sf_dir)}/good", TRADE)
    return batches.first_arrivals(good).select("trade_id", "product", "price", "size", "time", "processed_at")


@query
def stream_dead_letters(spark, sf_dir):
    """What the same stream could not use, as it came, with the reason."""
    letters = spark.read.parquet(f"{enriched(spark, sf_dir)}/rejects")
    return letters.groupBy("trade_id", "product", "price", "reason").agg(F.count(F.lit(1)).alias("records"))


@query
def micro_batch_refresh(spark, sf_dir):
    out = scratch_path(spark, "partials")
    writer = event_stream(spark, sf_dir).writeStream.foreachBatch(appended.put_partials(out, BOUNDS))
    feeds.run_available(spark, writer)
    return batch.rollup_summary(stores.read_appended(spark, out))


@query
def flush_count_or_time(spark, sf_dir):
    """Batches of at most FLUSH_BATCH trades or FLUSH_HOURS, with the reason why each was closed."""
    stateful(spark)
    span = FLUSH_HOURS * HOUR
    rows = closed(spark, sf_dir, lambda s, m: flush.flush_count_or_time(s, FLUSH_BATCH, span, marks=m), span)
    return rows.groupBy("product", "flush", "reason").agg(
        F.count(F.lit(1)).alias("rows"), F.min("trade_id").alias("first_id"), F.max("time").alias("last_time")
    )


@query
def flush_file_sizes(spark, sf_dir):
    out = scratch_path(spark, "flush")
    feeds.run_available(spark, feeds.raw_batches(event_stream(spark, sf_dir), out, FLUSH_ROWS))
    files_read = spark.read.schema("trade_id long").json(out).groupBy(F.input_file_name().alias("file"))
    sizes = files_read.agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.sum("n").alias("rows"), F.count_if(F.col("n") > FLUSH_ROWS).alias("oversized_files"))


def alert_ticks(spark, sf_dir) -> DataFrame:
    return fleet_ticks(spark, sf_dir).withColumn("level", (F.col("instances") % 3 + 1).cast("int"))


@query
def hysteresis_alerts(spark, sf_dir):
    return fleet.hysteresis_alerts(alert_ticks(spark, sf_dir), ALERTS)


@query
def stream_hysteresis_alerts(spark, sf_dir):
    stateful(spark)
    path = scratch_path(spark, "ticks")
    ticks = alert_ticks(spark, sf_dir).select("fleet", "ts", "level", "cpu")
    ticks.write.parquet(path)
    reader = spark.readStream.schema(ticks.schema).option("maxFilesPerTrigger", feeds.FILES_PER_BATCH)
    return stored(spark, state.stream_alerts(reader.parquet(path), ALERTS))
