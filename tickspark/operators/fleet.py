"""Fleet metrics and threshold alerts with hysteresis."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import exact_avg, round_half_up
from ..functions.times import slot_number, slot_start
from .holdoff import BLOCK_ROWS, greedy_holdoff
from .ordered import settle


@dataclass(frozen=True)
class AlertRule:
    """Thresholds of the up/down alerts. Seconds throughout; delays say how long an action takes."""

    high: float = 20.0
    low: float = 10.0
    min_level: int = 1
    max_level: int = 3
    hold: float = 60.0
    cooldown: float = 30.0
    up_delay: float = 0.0
    down_delay: float = 0.0


def fleet_average(samples: DataFrame, period_seconds: int = 60) -> DataFrame:
    """Mean over instances of their newest sample per (fleet, period); zero where none has data."""
    period = slot_number("ts", period_seconds)
    newest = F.max(F.when(F.col("cpu").isNotNull(), F.struct("ts", "cpu")))["cpu"]
    return (
        samples.groupBy("fleet", period.alias("period"), "instance_id")
        .agg(newest.alias("cpu"))
        .groupBy("fleet", "period")
        .agg(
            F.coalesce(exact_avg("cpu"), F.lit(0.0)).alias("cpu"),
            F.count("cpu").alias("instances_with_data"),
            F.count(F.lit(1)).alias("instances"),
        )
        .select(
            "fleet",
            slot_start("period", period_seconds).alias("ts"),
            "cpu",
            "instances_with_data",
            "instances",
        )
    )


def _seconds(value: float) -> int:
    return round(value * 1_000_000)


def low_since(ticks: DataFrame, low: Column, part_seconds: int = 86_400) -> DataFrame:
    """Add ``low_since``, the micros at which the current unbroken run of low ticks began.

    A run may span days: each day hands on whether it ended low and when the run started, so no
    window holds more than one fleet's day, or one row per day of a fleet.
    """
    rows = ticks.withColumns(
        {
            "_us": F.unix_micros("ts"),
            "_low": low,
            "_part": slot_number("ts", part_seconds),
        }
    )
    ends = rows.groupBy("fleet", "_part").agg(F.max_by("_low", "_us").alias("_ended_low"))
    by_part = Window.partitionBy("fleet").orderBy("_part")
    before = ends.select("fleet", "_part", F.lag("_ended_low", 1, False).over(by_part).alias("_entered_low"))
    inside = Window.partitionBy("fleet", "_part").orderBy("_us")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    starts = rows.join(before, ["fleet", "_part"]).withColumn(
        "_start",
        F.when(
            F.col("_low") & ~F.coalesce(F.lag("_low").over(inside), F.col("_entered_low")), F.col("_us")
        ),
    )
    part_starts = starts.groupBy("fleet", "_part").agg(F.max("_start").alias("_last_start"))
    earlier = part_starts.select(
        "fleet",
        "_part",
        F.max("_last_start").over(by_part.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"),
    )
    return (
        starts.withColumn("_here", F.max("_start").over(upto))
        .join(earlier, ["fleet", "_part"])
        .withColumn("low_since", F.when(F.col("_low"), F.coalesce("_here", "_carried")))
        .select(*ticks.columns, "low_since")
    )


def eligible_ticks(ticks: DataFrame, rule: AlertRule) -> DataFrame:
    """Ticks that would act were there no cooldown; up wins over down."""
    low = (F.col("level") > rule.min_level) & (F.col("cpu") < rule.low)
    marked = low_since(ticks, F.coalesce(low, F.lit(False)))
    held = F.unix_micros("ts") - F.col("low_since") > F.lit(_seconds(rule.hold))
    up = (F.col("level") < rule.max_level) & (F.col("cpu") > rule.high)
    return marked.withColumn("action", F.when(up, "scale_up").when(held, "scale_down")).filter(
        F.col("action").isNotNull()
    )


def event_rows(acted: DataFrame, rule: AlertRule) -> DataFrame:
    """Event records with capacity before and after, and the reason in words."""
    shown = F.format_string("%.1f", round_half_up(F.col("cpu"), 1))
    up = F.col("action") == "scale_up"
    reason = F.when(up, F.concat(F.lit("CPU "), shown, F.lit(f"% > {rule.high:g}%"))).otherwise(
        F.concat(F.lit("CPU "), shown, F.lit(f"% < {rule.low:g}% for {rule.hold:g}s"))
    )
    step = F.when(up, F.lit(1)).otherwise(F.lit(-1))
    return acted.select(
        "fleet",
        F.col("ts").alias("timestamp"),
        "action",
        F.col("level").cast("int").alias("old_capacity"),
        (F.col("level") + step).cast("int").alias("new_capacity"),
        reason.alias("reason"),
    )


def hysteresis_alerts(ticks: DataFrame, rule: AlertRule = AlertRule(), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Up/down events per fleet from ticks (fleet, ts, level, cpu), one tick per fleet and instant.

    Which ticks would act depends on the data alone; the cooldown then selects among them greedily.
    """
    known = settle(ticks.select("fleet", "ts", "level", "cpu"), "ticks")
    chosen = settle(eligible_ticks(known, rule), "eligible")
    wait = {
        name: _seconds(rule.cooldown + delay) + 1  # strictly longer than the cooldown
        for name, delay in (("scale_up", rule.up_delay), ("scale_down", rule.down_delay))
    }
    hold = F.when(F.col("action") == "scale_up", F.lit(wait["scale_up"])).otherwise(F.lit(wait["scale_down"]))
    acted = greedy_holdoff(
        chosen.withColumn("tick", F.unix_micros("ts")), ["fleet"], "ts", "tick", hold, max(wait.values()), block_rows
    )
    return event_rows(acted, rule)
