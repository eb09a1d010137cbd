"""SQL access: trades as named views, and the stock dashboard statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

VIEWS = ("trades", "speed_trades")


def register_views(trades: DataFrame, *names: str) -> None:
    """Expose a trades frame to ``spark.sql`` under the given names."""
    for name in names or VIEWS:
        trades.createOrReplaceTempView(name)


def recent_totals(spark, as_of: str, minutes: int = 1, view: str = "trades") -> DataFrame:
    """Count, mean price and volume of the last minutes. Typed, zero where there is nothing."""
    return spark.sql(
        f"""
        SELECT count(*) AS trade_count,
               coalesce(try_divide(cast(sum(cast(price AS decimal(38,8))) AS double), count(price)), 0) AS avg_price,
               coalesce(cast(sum(cast(size AS decimal(38,8))) AS double), 0) AS total_volume
        FROM {view}
        WHERE processed_at >= {as_of} - INTERVAL '{int(minutes)}' MINUTE
        """
    )


def recent_count(spark, as_of: str, minutes: int = 5, view: str = "trades", product: str = "BTC-USD"):
    return spark.sql(
        f"""
        SELECT count(*) AS trade_count FROM {view}
        WHERE product = :product AND processed_at >= {as_of} - INTERVAL '{int(minutes)}' MINUTE
        """,
        args={"product": product},
    )


def latency_avg_p95(spark, as_of: str, minutes: int = 5, view: str = "speed_trades") -> DataFrame:
    return spark.sql(
        f"""
        SELECT try_divide(cast(sum(cast(latency_ms AS decimal(38,8))) AS double), count(latency_ms)) AS avg_latency,
               percentile_cont(0.95) WITHIN GROUP (ORDER BY latency_ms) AS p95_latency
        FROM {view}
        WHERE processed_at >= {as_of} - INTERVAL '{int(minutes)}' MINUTE
        LIMIT 100
        """
    )


def newest(view: str = "trades") -> str:
    """SQL for the newest processing time of a view, to pass as ``as_of``."""
    return f"(SELECT max(processed_at) FROM {view})"


def sql_conjunct_filter(trades: DataFrame, product: str, since) -> DataFrame:
    """Trades of one product since an instant, a filter that reaches a stored table's scan."""
    return trades.filter((F.col("product") == product) & (F.col("processed_at") >= since))
