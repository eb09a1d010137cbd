"""What the plans must look like, and how the shared folder is chosen."""

import pytest
from pyspark.sql import functions as F

from tickspark.operators import batch, dedup, quality, recent, windows
from tickspark.schema import EVENT_PRICE_BOUNDS, TRADE, read_trades
from tickspark.session import shared_dir


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def table(spark, sf_dir, folder):
    """Trades as a stored table, whose columns filters can reach."""
    read_trades(spark, sf_dir).write.parquet(f"{folder}/trades")
    return spark.read.parquet(f"{folder}/trades")


def test_batch_summary_is_one_shuffle_over_needed_columns(table):
    text = plan(batch.batch_summary(table, EVENT_PRICE_BOUNDS))
    assert text.count("Exchange") == 1
    assert "GreaterThan(price,0.0)" in text
    assert "processed_at" not in text and "trade_id" not in text


def test_roll_up_shuffles_partials_only(table):
    text = plan(windows.sliding_window_summary(table, 60, 10))
    assert text.count("Exchange") == 2 and text.count("partial_sum") >= 2


@pytest.mark.parametrize(
    "build",
    [
        lambda t: windows.top_k_trades_per_window(t, 5, 60, 10),
        lambda t: dedup.dedup_by_trade_id(t),
        lambda t: recent.newest_per_product(t, 30),
    ],
)
def test_ranked_rows_are_limited_before_the_shuffle(table, build):
    text = plan(build(table))
    assert "Partial" in text and "WindowGroupLimit" in text


def test_no_cartesian_products(spark, table):
    for frame in (
        recent.recent_or_last_n(table),
        recent.latency_by_rate(table),
        batch.batch_counters(table),
        recent.recent_trades(table),
    ):
        text = plan(frame)
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_product_filter_reaches_the_scan(table):
    kept = quality.require_product(table).filter(F.col("product") == "click")
    assert "EqualTo(product,click)" in plan(kept)


class FakeContext:
    """Just enough of a context to see which folder is chosen."""

    def __init__(self, conf, master="spark://host:7077", set_dir=None):
        self.conf, self.master, self.set_dir = conf, master, set_dir

    def getConf(self):
        return self.conf

    def getCheckpointDir(self):
        return self.set_dir


class FakeSession:
    def __init__(self, runtime, core, **context):
        self.conf, self.sparkContext = runtime, FakeContext(core, **context)


def test_shared_folder_comes_from_the_session():
    named = {"spark.checkpoint.dir": "/shared/a"}
    assert shared_dir(FakeSession(named, {})) == "/shared/a"
    assert shared_dir(FakeSession({}, named, set_dir="/other")) == "/shared/a"
    assert shared_dir(FakeSession({}, {}, set_dir="/shared/b")) == "/shared/b"
    with pytest.raises(RuntimeError):
        shared_dir(FakeSession({}, {}))


def test_empty_input(spark):
    none = spark.createDataFrame([], TRADE)
    assert batch.batch_summary(none).count() == 0
    assert batch.batch_counters(none).first()["is_empty"]
    assert windows.sliding_window_summary(none).count() == 0
    assert windows.rolling_last_n_snapshot(none).count() == 0
    assert recent.recent_or_last_n(none).count() == 0
