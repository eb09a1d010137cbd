"""Pieces that several operators share: word splitting, scratch tables, free column names."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..session import scratch_path

# White space of the contracts, as the inside of a character class.
BLANK = r"\x20\x09-\x0D"
HELD_OUT_FOLDS = 5


def text_of(column: str | Column = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words (maximal runs of characters that are not blank)."""
    return F.filter(F.split(text, f"[{BLANK}]+", -1), lambda w: w != "")


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the fifth of all ids that no model may learn labels from."""
    name = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(name.cast("string"), F.lit("")).cast("binary")) % HELD_OUT_FOLDS == 0


def free_names(frame: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``frame`` has (compared without case)."""
    taken = {c.lower() for c in frame.columns}
    found = []
    for name in names:
        tail = 0
        free = f"_{name}"
        while free.lower() in taken:
            tail += 1
            free = f"_{name}_{tail}"
        taken.add(free.lower())
        found.append(free)
    return found


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a derived table to the cluster's shared folder and read it back.

    Cuts lineage, survives lost executors, and tells the planner the table's size.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def same(left: Column, right: Column) -> Column:
    """Equality under which nulls are equal, for joins on keys that may be null."""
    return left.eqNullSafe(right)


def per_process(key: str, build: Callable[[], object]):
    """What ``build`` makes, once for each Python process: workers keep it from task to task.

    Task functions travel by value, so their own module's globals don't outlive a task. A worker keeps
    one thing at a time: what another operator asks for takes the place of what was there.
    """
    kept = sys.modules.setdefault("_tickspark_kept", types.ModuleType("_tickspark_kept")).__dict__
    objects = kept.setdefault("objects", {})
    if key not in objects:
        objects.clear()
        objects[key] = build()
    return objects[key]


class Remembered(dict):
    """Results of a function by its string argument: those used since the last turn, and those before it.

    Holds at most two generations of ``entries``; long arguments are not kept.
    """

    def __init__(self, function: Callable[[str], object], entries: int, longest: int = 48):
        super().__init__()
        self.function, self.entries, self.longest, self.old = function, entries, longest, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.function(key)
            if len(key) > self.longest:
                return found
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


def sorted_runs(batches, keys: list[str]):
    """(key values, table of its rows) for each run of equal keys in batches sorted by ``keys``.

    Holds one run at a time. Keys are integers without nulls.
    """
    import numpy as np
    import pyarrow as pa

    held, last = [], None
    for b in batches:
        if not b.num_rows:
            continue
        columns = [b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(b.num_rows, dtype=bool)
        new[0] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(new).tolist()
        for i, j in zip(starts, [*starts[1:], b.num_rows]):
            key = tuple(c[i].item() for c in columns)
            if key != last and held:
                yield last, pa.Table.from_batches(held)
                held = []
            last = key
            held.append(b.slice(i, j - i))
    if held:
        yield last, pa.Table.from_batches(held)
