"""Order-dependent building blocks that never gather one whole key in a task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import scratch_path

PART_WIDTH = 4096


def settle(frame: DataFrame, name: str = "settled") -> DataFrame:
    """Compute a derived table once, as a table in the shared folder.

    Later plans start from its files: nothing behind it is computed again, lost executors do not
    matter, and the planner knows its size, so it broadcasts the table only when that is small.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def running_before(
    rows: DataFrame, keys: list[str], position: str, amount: str | Column, out: str, width: int = PART_WIDTH
) -> DataFrame:
    """Exclusive running sum of ``amount`` per key in ``position`` order, as column ``out``.

    ``position`` is an integer, unique per key. Sums run inside parts of ``width`` positions, and
    the part totals run over the key, so a window group holds ``width`` rows or one row per part.
    ``rows`` are counts or the like; they are needed twice and therefore settled.
    """
    value = F.col(amount) if isinstance(amount, str) else amount
    zero = F.lit(0)
    parted = settle(rows.withColumn("_part", F.floor(F.col(position) / F.lit(width))), "parts")
    inside = Window.partitionBy(*keys, "_part").orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        parted.groupBy(*keys, "_part")
        .agg(F.sum(value).alias("_total"))
        .select(*keys, "_part", F.coalesce(F.sum("_total").over(across), zero).alias("_earlier"))
    )
    return (
        parted.withColumn("_inside", F.coalesce(F.sum(value).over(inside), zero))
        .join(totals, [*keys, "_part"])
        .withColumn(out, F.col("_inside") + F.col("_earlier"))
        .drop("_part", "_inside", "_earlier")
    )


def tail_cut(rows: DataFrame, keys: list[str], need: int, micros_per_step: int) -> DataFrame:
    """Per key, the latest step of ``us`` from which on at least ``need`` rows remain, as ``cut``.

    Keys with fewer rows get their first step. Only counts per step are shuffled.
    """
    step = F.floor(F.col("us") / F.lit(micros_per_step)).cast("long")
    later = Window.partitionBy(*keys).orderBy(F.col("_step").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.groupBy(*keys, step.alias("_step"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_later", F.coalesce(F.sum("_n").over(later), F.lit(0)))
        .filter(F.col("_later") < need)
        .groupBy(*keys)
        .agg((F.min("_step") * F.lit(micros_per_step)).alias("cut"))
    )


def exact_percentiles(
    counted: DataFrame, keys: list[str], value: str, freq: str, probs: dict[str, float], parts: int | None = None
) -> DataFrame:
    """Interpolated percentiles per key from a settled (key, value, frequency) table.

    The rows, one for each distinct value of a key, are dealt by range to ``parts`` (by default the session's
    shuffle partitions), which come out even however the values are distributed. Running counts over the
    parts tell which of them hold the wanted ranks, and only those are looked into. ``probs`` maps output
    columns to probabilities.
    """
    parts = parts or int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = counted.repartitionByRange(parts, *keys, value).withColumn("_bin", F.spark_partition_id())
    binned = settle(dealt, "ranged")
    before = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    bins = (
        binned.groupBy(*keys, "_bin")
        .agg(F.sum(freq).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    )
    sizes = bins.groupBy(*keys).agg(F.sum("_n").alias("_size"))
    wanted = []
    for name, p in probs.items():
        spot = F.lit(float(p)) * (F.col("_size") - 1)
        for end, rank in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            wanted.append(
                F.struct(F.lit(f"{name}_{end}").alias("mark"), rank.cast("long").alias("rank"))
            )
    marks = (
        bins.join(sizes, keys)
        .withColumn(
            "_marks",
            F.filter(
                F.array(*wanted),
                lambda m: (m["rank"] >= F.col("_before")) & (m["rank"] < F.col("_before") + F.col("_n")),
            ),
        )
        .filter(F.size("_marks") > 0)
        .select(*keys, "_bin", "_before", "_marks")
    )
    inside = Window.partitionBy(*keys, "_bin").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    hits = (
        binned.join(marks, [*keys, "_bin"])
        .withColumn("_upto", F.col("_before") + F.sum(freq).over(inside))
        .select(*keys, value, freq, "_upto", F.inline("_marks"))
        .filter((F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col(freq)))
    )
    picked = [
        F.max(F.when(F.col("mark") == f"{name}_{end}", F.col(value))).alias(f"_{name}_{end}")
        for name in probs
        for end in ("lo", "hi")
    ]
    result = hits.groupBy(*keys).agg(*picked).join(sizes, keys)
    outputs = []
    for name, p in probs.items():
        spot = F.lit(float(p)) * (F.col("_size") - 1)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        outputs.append((lo + (hi - lo) * (spot - F.floor(spot))).alias(name))
    return result.select(*keys, *outputs)
