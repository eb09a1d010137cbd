"""Removal of byte strings that occur more than once, by merged Burrows-Wheeler transforms of what may repeat."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_128_digest

from .bwt import END, repeated, transform
from .common import per_process, stored

LENGTH = 200  # bytes of a string that must not start anywhere else
GRAM = 40  # bytes of the grams that decide where a window belongs
PIECE = 1 << 18  # bytes of text looked at in one go
PLACE_BITS = 20  # for places in up to 2 * PIECE + LENGTH bytes
BIN = 1 << 21  # bytes of distinct stretches in one merge, on average
SHARDS = 4  # transforms a merge takes
CROWDED = 1 << 22  # bytes of distinct stretches with one least gram beyond which windows are counted instead
FLUSH = 1 << 24

# An odd multiplier for rolling hashes modulo 2^64, and its inverse.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a number for each byte, powers of BASE, powers of INVERSE), enough for one piece."""

    def build():
        with np.errstate(over="ignore"):
            rows = []
            for base in (BASE, INVERSE):
                power = np.full(3 * PIECE, base, dtype=np.uint64)
                power[0] = 1
                rows.append(np.multiply.accumulate(power))
        return np.random.default_rng(1).integers(1, 1 << 63, size=256, dtype=np.uint64), *rows

    return per_process("repeats:powers", build)


def least_grams(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``length`` bytes the least gram inside: (its hash, its place), the first of equals.

    Hashes are compared by their upper bits, the place fills the others; equal windows choose alike.
    """
    names, power, back = _powers()
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(names[data] * power[: len(data)], out=prefix[1:])
        hashed = (prefix[gram:] - prefix[:-gram]) * back[: len(data) - gram + 1]
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = (hashed & ~low) | np.arange(len(hashed), dtype=np.uint64)
    width, reach = length - gram + 1, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
    place = (least & low).astype(np.int64)
    return hashed[place], place


def _pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (text number, offset, bytes) of about PIECE bytes; every window is whole in one of them."""
    held, size = [], 0
    for number, data in enumerate(texts):
        for at in range(0, max(0, len(data) - length + 1), PIECE):
            part = data[at : at + PIECE + length - 1]
            held.append((number, at, part))
            size += len(part)
            if size >= PIECE:
                yield held
                held, size = [], 0
    if held:
        yield held


def stretches(texts: list[bytes], length: int = LENGTH, gram: int = GRAM, digest: bool = True):
    """(text number, start, windows, least gram, digest) arrays, for pieces of the texts.

    A stretch is a row of neighbouring windows whose least gram is the same one, at the same place. Equal
    windows lie in two stretches with equal grams, even where they overlap: so only stretches that share one
    can hold them. A stretch's bytes are those of its windows.
    """
    for held in _pieces(texts, length):
        buffer = b"".join(part for *_, part in held)
        data = np.frombuffer(buffer, dtype=np.uint8)
        size = np.array([len(part) for *_, part in held])
        end = np.cumsum(size)
        least, place = least_grams(data, length, gram)
        piece = np.repeat(np.arange(len(held)), size)[: len(least)]
        spot = np.flatnonzero(np.arange(len(least)) + length <= end[piece])
        own, part = place[spot], piece[spot]
        new = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (part[1:] != part[:-1])])
        first, count = spot[new], np.diff(np.r_[new, len(spot)])
        gram_of, part = least[first].view(np.int64), piece[first]
        number = np.array([n for n, *_ in held])[part]
        start = first - (end - size)[part] + np.array([at for _, at, _ in held])[part]
        names = None
        if digest:
            view = memoryview(buffer)
            sums = [xxh3_128_digest(view[i : i + c + length - 1]) for i, c in zip(first.tolist(), count.tolist())]
            names = np.frombuffer(b"".join(sums), dtype=np.int64).reshape(-1, 2)
        yield number, start, count, gram_of, names


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [(t.as_py() or "").encode() for t in _column(batch, "text")]


def _grams(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(gram, n): least grams of the stretches, counted within pieces."""

    def run(batches):
        for b in batches:
            for *_, grams, _ in stretches(_texts(b), length, gram, digest=False):
                value, n = np.unique(grams, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(n)], ["gram", "n"])

    return docs.select("text").mapInArrow(run, "gram long, n long")


def _stretches(docs: DataFrame, kind: str, length: int, gram: int) -> DataFrame:
    """Every stretch: its document, place, number of windows, least gram and digest."""
    names = ["doc_id", "text_key", "start", "windows", "gram", "d1", "d2"]

    def run(batches):
        for b in batches:
            ids, keys = _column(b, "doc_id"), _column(b, "text_key")
            for number, start, count, grams, sums in stretches(_texts(b), length, gram):
                spot = pa.array(number)
                columns = [ids.take(spot), keys.take(spot), *map(pa.array, (start, count, grams, sums[:, 0].copy(), sums[:, 1].copy()))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names[1:]))


def _cut(wanted: DataFrame, docs: DataFrame, kind: str, length: int) -> DataFrame:
    """The bytes of chosen stretches: (bin, shard, d1, d2, n, doc_id, text_key, start, bytes)."""
    by = (F.col("w.doc_id").eqNullSafe(F.col("d.doc_id"))) & (F.col("w.text_key") == F.col("d.text_key"))
    lists = wanted.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("bin", "shard", "d1", "d2", "n", "start", "windows")).alias("parts")
    )
    joined = docs.alias("d").join(lists.alias("w"), by).select("d.doc_id", "d.text_key", "d.text", "w.parts")
    names = ["bin", "shard", "d1", "d2", "n", "doc_id", "text_key", "start", "bytes"]

    def run(batches):
        def made(rows, ids, b):
            spots = pa.array(ids, pa.int64())
            bins, shards, d1, d2, n, start, data = (list(c) for c in zip(*rows))
            longs = [pa.array(c, pa.int64()) for c in (bins, shards, d1, d2, n)]
            place = [_column(b, "doc_id").take(spots), _column(b, "text_key").take(spots)]
            return pa.RecordBatch.from_arrays([*longs, *place, pa.array(start, pa.int64()), pa.array(data, pa.binary())], names)

        for b in batches:
            rows, ids, held = [], [], 0
            for spot, parts in enumerate(_column(b, "parts").to_pylist()):
                text = (_column(b, "text")[spot].as_py() or "").encode()
                for p in parts:
                    data = text[p["start"] : p["start"] + p["windows"] + length - 1]
                    rows.append((p["bin"], p["shard"], p["d1"], p["d2"], p["n"], p["start"], data))
                    ids.append(spot)
                    held += len(data)
                    if held >= FLUSH:
                        yield made(rows, ids, b)
                        rows, ids, held = [], [], 0
            if rows:
                yield made(rows, ids, b)

    longs = ", ".join(f"{n} long" for n in names[:5])
    return joined.mapInArrow(run, f"{longs}, doc_id {kind}, text_key long, start long, bytes binary")


def _transforms(cut: DataFrame, kind: str) -> DataFrame:
    """One row for each shard of a bin: the transform of its distinct strings, and where they come from."""
    lists = [("n", "long"), ("doc_id", kind), ("text_key", "long"), ("start", "long")]

    def run(key, table):
        data = table.column("bytes").to_pylist()
        spots, last = [], None
        for i in sorted(range(len(data)), key=data.__getitem__):  # a document given twice gives its strings twice
            if data[i] != last:
                spots.append(i)
                last = data[i]
        symbols = transform([data[i] for i in spots])
        took = table.select([n for n, _ in lists]).take(pa.array(spots)).combine_chunks()
        own = [pa.ListArray.from_arrays(pa.array([0, len(spots)], pa.int32()), took.column(n).combine_chunks()) for n, _ in lists]
        ends = np.flatnonzero(symbols == END).astype(np.int32)
        before = np.where(symbols == END, 0, symbols - 1).astype(np.uint8).tobytes()
        columns = [table.column("bin")[:1], table.column("shard")[:1], pa.array([before], pa.binary())]
        columns += [pa.array([ends.tolist()], pa.list_(pa.int32())), *own]
        return pa.Table.from_arrays(columns, names=["bin", "shard", "before", "ends", *[n for n, _ in lists]])

    shape = "bin long, shard long, before binary, ends array<int>, " + ", ".join(f"{n} array<{t}>" for n, t in lists)
    return cut.groupBy("bin", "shard").applyInArrow(run, shape)


def _merged(transforms: DataFrame, kind: str, length: int) -> DataFrame:
    """(doc_id, text_key, first, last): bytes of repeated windows in stretches that occur once."""
    names = ["doc_id", "text_key", "first", "last"]

    def run(key, table):
        symbols = []
        for before, ends in zip(table.column("before"), table.column("ends")):
            own = np.frombuffer(before.as_py(), dtype=np.uint8).astype(np.int16) + np.int16(1)
            own[ends.values.to_numpy()] = END
            symbols.append(own)
        out = []
        for row, (owner, offset) in enumerate(repeated(symbols, length)):
            cell = lambda n: table.column(n)[row].values
            alone = cell("n").to_numpy()[owner] == 1
            owner, offset = owner[alone], offset[alone]
            order = np.lexsort((offset, owner))
            owner, offset = owner[order], offset[order]
            new = np.r_[True, (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)] if len(owner) else np.empty(0, bool)
            first = np.flatnonzero(new)
            last = np.r_[first[1:], len(owner)] - 1 if len(first) else first
            spot = pa.array(owner[first])
            begin = cell("start").to_numpy()[owner[first]]
            columns = [cell("doc_id").take(spot), cell("text_key").take(spot)]
            columns += [pa.array(begin + offset[first]), pa.array(begin + offset[last] + length)]
            out.append(pa.Table.from_arrays(columns, names=names))
        return pa.concat_tables(out)

    return transforms.groupBy("bin").applyInArrow(run, f"doc_id {kind}, text_key long, first long, last long")


def _counted(cut: DataFrame, kind: str, length: int) -> DataFrame:
    """The same by digests of single windows: the way for grams with very many different stretches."""
    names = ["w1", "w2", "d1", "d2", "offset", "n", "doc_id", "text_key", "start"]

    def run(batches):
        for b in batches:
            for spot, data in enumerate(_column(b, "bytes")):
                view = memoryview(data.as_buffer())
                count = len(view) - length + 1
                sums = np.frombuffer(b"".join(xxh3_128_digest(view[i : i + length]) for i in range(count)), dtype=np.int64)
                same = pa.array(np.full(count, spot))
                rest = [_column(b, n).take(same) for n in ("n", "doc_id", "text_key", "start")]
                d = [_column(b, n).take(same) for n in ("d1", "d2")]
                columns = [pa.array(sums[0::2].copy()), pa.array(sums[1::2].copy()), *d, pa.array(np.arange(count)), *rest]
                yield pa.RecordBatch.from_arrays(columns, names)

    longs = ", ".join(f"{n} long" for n in names[:6])
    windows = cut.mapInArrow(run, f"{longs}, doc_id {kind}, text_key long, start long").dropDuplicates(["d1", "d2", "offset"])
    windows = stored(windows, "windows")
    many = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("w1", "w2")
    first = F.col("start") + F.col("offset")
    found = windows.filter("n = 1").join(many, ["w1", "w2"], "left_semi")
    return found.select("doc_id", "text_key", first.alias("first"), (first + length).alias("last"))


def repeated_bytes(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bin_bytes: int = BIN, crowded: int = CROWDED, shards: int = SHARDS
) -> DataFrame:
    """(doc_id, text_key, first, last): ranges of bytes that windows of ``length`` bytes cover which also start elsewhere.

    ``docs`` has doc_id, text and text_key, a hash of the text. Ranges may overlap; rows of equal id and text
    have the same. Steps, each a shuffle of what the one before left over:

    1. Neighbouring windows with the same least gram form stretches. Stretches whose gram no other has hold
       no repeated window; the rest are kept, without their text.
    2. Stretches with equal bytes are one class. In a class of two or more every window repeats.
    3. Classes that share a gram with another class meet in a bin, one text for each. A bin's strings are
       dealt to shards, each shard's transform is built, and the transforms of a bin are merged.

    A gram with more than ``crowded`` bytes of different classes would overfill its bin. Its windows are
    counted by their digests instead, which splits them however many there are.
    """
    kind = dict(docs.dtypes)["doc_id"]
    often = _grams(docs, length, gram).groupBy("gram").agg(F.sum("n").alias("_n")).filter("_n > 1").select("gram")
    live = stored(_stretches(docs, kind, length, gram).join(often, "gram", "left_semi"), "stretches")
    sample = [F.first(c).alias(c) for c in ("doc_id", "text_key", "start", "windows")]  # all of one row
    classes = stored(live.groupBy("gram", "d1", "d2").agg(F.count(F.lit(1)).alias("n"), *sample), "classes")
    shared = stored(
        classes.groupBy("gram").agg(F.count(F.lit(1)).alias("_k"), F.sum(F.col("windows") + length - 1).alias("size")).filter("_k > 1"),
        "grams",
    )
    total = shared.filter(F.col("size") <= crowded).agg(F.sum("size")).first()[0] or 0
    bins = int(total // bin_bytes) + 1
    where = F.when(F.col("size") <= crowded, F.pmod(F.xxhash64("gram"), F.lit(bins)))
    contested = classes.join(shared.select("gram", "size"), "gram").select(
        "*", where.alias("bin"), F.pmod("d1", F.lit(shards)).alias("shard")
    )
    cut = stored(_cut(contested, docs, kind, length), "strings")
    once = _merged(_transforms(cut.filter("bin IS NOT NULL"), kind), kind, length)
    hot = _counted(cut.filter("bin IS NULL"), kind, length)
    often_class = classes.filter("n > 1").select("gram", "d1", "d2")
    every = live.join(often_class, ["gram", "d1", "d2"], "left_semi").select(
        "doc_id", "text_key", F.col("start").alias("first"), (F.col("start") + F.col("windows") + length - 1).alias("last")
    )
    return every.unionByName(once).unionByName(hot)


def without_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """(doc_id, n_bytes, spans array<struct<first, last>>, kept binary) of every row.

    Texts are their UTF-8 bytes. Each byte covered by a string of ``length`` bytes that also starts anywhere
    else, in this row or another, is removed, all occurrences alike; strings are judged on the input. ``spans``
    are the maximal removed runs [first, last), ``kept`` the other bytes, which need not be valid UTF-8.

    Null and short texts lose nothing; a repeated row counts as a place of its own, so equal rows of at least
    ``length`` bytes lose everything. Null ids stay, no rows give no rows, other columns are not read.
    """
    kind = dict(docs.dtypes)[id_col]
    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("text_key")
    )
    found = repeated_bytes(slim, length, **more).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    by = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.text_key") == F.col("f.text_key"))
    joined = slim.alias("d").join(found.alias("f"), by, "left").select("d.doc_id", "d.text", "f.ranges")
    names = ["doc_id", "n_bytes", "spans", "kept"]
    span = pa.struct([("first", pa.int64()), ("last", pa.int64())])

    def run(batches):
        def made(b, first, sizes, spans, kept):
            ids = _column(b, "doc_id").slice(first, len(sizes))
            columns = [ids, pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names)

        for b in batches:
            ranges = _column(b, "ranges")
            first, sizes, spans, kept, held = 0, [], [], [], 0
            for spot, data in enumerate(_texts(b)):
                own, parts, at = [], [], 0
                if ranges[spot].is_valid:
                    flat = ranges[spot].values
                    low, high = (flat.field(i).to_numpy() for i in (0, 1))
                    order = np.argsort(low, kind="stable")
                    low, high = low[order], np.maximum.accumulate(high[order])
                    new = np.flatnonzero(np.r_[True, low[1:] > high[:-1]])
                    for i, j in zip(low[new].tolist(), high[np.r_[new[1:], len(low)] - 1].tolist()):
                        own.append({"first": i, "last": j})
                        parts.append(data[at:i])
                        at = j
                parts.append(data[at:])
                sizes.append(len(data))
                spans.append(own)
                kept.append(b"".join(parts))
                held += len(data)
                if held >= FLUSH:
                    yield made(b, first, sizes, spans, kept)
                    first, sizes, spans, kept, held = spot + 1, [], [], [], 0
            if sizes:
                yield made(b, first, sizes, spans, kept)

    shape = f"doc_id {kind}, n_bytes long, spans array<struct<first: bigint, last: bigint>>, kept binary"
    return joined.mapInArrow(run, shape).withColumnRenamed("doc_id", id_col)
