"""Versions of a keyed store: appended batches are folded into a new base, and a manifest switches to it at once.

Layout beside the ``batch_id=N`` folders of ``sinks.appended``: ``_base/<name>`` holds folded rows, and
``_versions/<number>.json`` says which base is valid, which older ones ``below`` it still are, and up to which
batch they have everything. A merge folds an older base too unless that is more than ``GROWTH`` times the rest, so
a row is rewritten a logarithmic number of times, not by every merge. A manifest is
written under another name and renamed to a name that must be free: of two writers one wins, and readers see
the old version or the new one. Nothing that a version names is changed afterwards.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.dedup import dedup_by_trade_id
from .appended import upsert_trades

NOTHING = {"version": 0, "base": None, "below": [], "through": -1}
GROWTH = 2


class Lost(RuntimeError):
    """Another writer has published the version this one had prepared."""


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def _listed(spark: SparkSession, *parts: str) -> list[str]:
    folder = _path(spark, *parts)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in system.listStatus(folder)) if system.exists(folder) else []


def _text(spark: SparkSession, *parts: str) -> str:
    file = _path(spark, *parts)
    source = file.getFileSystem(spark._jsc.hadoopConfiguration()).open(file)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """The newest manifest, or that of a version; before the first merge that of an empty base."""
    names = [n for n in _listed(spark, path, "_versions") if n.endswith(".json")]
    if version is not None:
        names = [n for n in names if int(n[:-5]) == version]
        if not names and version:
            raise ValueError(f"version {version} is not there (any more)")
    return json.loads(_text(spark, path, "_versions", names[-1])) if names else dict(NOTHING)


def publish(spark: SparkSession, path: str, new: dict) -> None:
    """Make a manifest valid, unless its number is taken."""
    conf = spark._jsc.hadoopConfiguration()
    draft, final = _path(spark, path, "_versions", f".{uuid.uuid4().hex}"), _path(spark, path, "_versions", f"{new['version']:020d}.json")
    system = draft.getFileSystem(conf)
    out = system.create(draft, False)
    out.write(json.dumps(new).encode())
    out.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    no_overwrite = spark._sc._gateway.new_array(rename, 0)
    try:
        spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), conf).rename(draft, final, no_overwrite)
    except Exception as error:
        system.delete(draft, False)
        if system.exists(final):
            raise Lost(f"version {new['version']} exists") from error
        raise


def _batches(spark: SparkSession, path: str, after: int, upto: int | None = None) -> list[int]:
    numbers = [int(n.split("=", 1)[1]) for n in _listed(spark, path) if n.startswith("batch_id=")]
    return sorted(n for n in numbers if n > after and (upto is None or n <= upto))


def _bases(state: dict) -> list[str]:
    """The bases of a version, the newest one last."""
    return [*state.get("below", []), *([state["base"]] if state["base"] else [])]


def _bytes(spark: SparkSession, *parts: str) -> int:
    folder = _path(spark, *parts)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def _rows(spark: SparkSession, path: str, bases: list[str], batches: list[int], schema: StructType) -> DataFrame:
    folders = [f"{path}/_base/{name}" for name in bases] + [f"{path}/batch_id={n}" for n in batches]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_store(
    spark: SparkSession, path: str, schema: StructType, key=("product", "trade_id"), version: int | None = None
) -> DataFrame:
    """The last write of every key: a version's bases, and for the newest version the batches after them.

    The folders are chosen now; what is merged or appended later does not change this table.
    """
    state = manifest(spark, path, version)
    batches = _batches(spark, path, state["through"]) if version is None else []
    return dedup_by_trade_id(_rows(spark, path, _bases(state), batches, schema), key)


def merge_store(
    spark: SparkSession, path: str, schema: StructType, key=("product", "trade_id"), through: int | None = None
) -> dict:
    """Fold the batches up to ``through`` (all there are) into a new base and switch to it.

    Until the switch, and if this fails, the old version stays valid. Merging what is merged changes nothing.
    """
    state = manifest(spark, path)
    batches = _batches(spark, path, state["through"], through)
    if not batches:
        return state
    below, folded = _bases(state), []
    size = sum(_bytes(spark, path, f"batch_id={n}") for n in batches)
    while below and (older := _bytes(spark, path, "_base", below[-1])) <= GROWTH * size:
        folded.append(below.pop())
        size += older
    name = f"v{state['version'] + 1}-{uuid.uuid4().hex}"
    dedup_by_trade_id(_rows(spark, path, folded, batches, schema), key).write.parquet(f"{path}/_base/{name}")
    new = {"version": state["version"] + 1, "base": name, "below": below, "through": batches[-1]}
    publish(spark, path, new)
    return new


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete what only versions before the newest ``keep`` need, and bases no version names; returns the names."""
    newest = manifest(spark, path)
    oldest = max(0, newest["version"] - keep + 1)
    kept = [manifest(spark, path, v) for v in range(max(1, oldest), newest["version"] + 1)]
    system = _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())
    known = {name for s in kept for name in _bases(s)}
    gone = [f"_base/{n}" for n in _listed(spark, path, "_base") if n not in known]
    gone += [f"_versions/{n}" for n in _listed(spark, path, "_versions") if n.endswith(".json") and int(n[:-5]) < oldest]
    folded = min((s["through"] for s in kept), default=-1)
    gone += [f"batch_id={n}" for n in _batches(spark, path, -1, folded)]
    for name in gone:
        system.delete(_path(spark, path, name), True)
    return gone


def upsert_and_merge(path: str, schema: StructType, key=("product", "trade_id"), every: int = 10) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of the keyed trade store that merges after every ``every`` batches.

    A retried batch replaces its folder; if a version has folded it already, readers don't look at it again.
    """
    append = upsert_trades(path, key)

    def write(batch: DataFrame, batch_id: int) -> None:
        append(batch, batch_id)
        if (batch_id + 1) % every == 0:
            merge_store(batch.sparkSession, path, schema, key, batch_id)

    return write
