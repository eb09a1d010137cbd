"""Time expressions: ISO parsing, slots, labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numeric import _col


def parse_iso(c: Column | str) -> Column:
    """ISO-8601 text with ``Z``, an offset, or none (read as session time); junk becomes NULL."""
    return F.try_to_timestamp(_col(c))


def micros(c: Column | str) -> Column:
    return F.unix_micros(_col(c))


def diff_ms(later: Column | str, earlier: Column | str) -> Column:
    return (micros(later) - micros(earlier)).cast("double") / F.lit(1000.0)


def slot_number(c: Column | str, seconds: int) -> Column:
    """Number, from the epoch on, of the slot of ``seconds`` that holds ``c``."""
    return F.floor(F.unix_seconds(_col(c)) / F.lit(seconds)).cast("long")


def slot_start(number: Column | str, seconds: int, shift: int = 0) -> Column:
    """Start of a numbered slot, ``shift`` seconds later."""
    return F.timestamp_seconds(_col(number) * F.lit(seconds) + F.lit(shift))


def minute_label(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd HH:mm")


def minute_of_day(c: Column | str) -> Column:
    return F.date_format(_col(c), "HH:mm")


def clock_label(c: Column | str) -> Column:
    return F.date_format(_col(c), "HH:mm:ss")
