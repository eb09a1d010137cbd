"""Verdict tiers used by the reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Tier limits, exclusive.
SPEEDUP_TIERS = ((3.0, "excellent"), (1.5, "good"))
SPEEDUP_REST = "limited"
THROUGHPUT_TIERS = ((50.0, "high"), (30.0, "moderate"))
THROUGHPUT_REST = "low"


def tier(c: Column, limits, rest: str) -> Column:
    (first, label), *others = limits
    expr = F.when(c > F.lit(first), F.lit(label))
    for limit, name in others:
        expr = expr.when(c > F.lit(limit), F.lit(name))
    return expr.otherwise(F.lit(rest))


def speedup_tier(c: Column) -> Column:
    return tier(c, SPEEDUP_TIERS, SPEEDUP_REST)


def throughput_tier(c: Column) -> Column:
    return tier(c, THROUGHPUT_TIERS, THROUGHPUT_REST)
