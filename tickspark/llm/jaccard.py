"""N-gram Jaccard join with token-combination prefixes."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import Remembered, per_process, same, sorted_runs, stored
from .components import components

U64 = np.uint64
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
CACHE_ENTRIES = 100_000
FLUSH = 1 << 20  # tokens a task holds before it sends them on
TEXTS = 256  # texts of a batch that are Python objects at a time
BLOCK_BITS = 20  # cells of the count table that are added up together
MOST_BITS = 30  # with more cells a task's counts would lie too far apart to be packed
KEY_BITS = 40
SPOT_BITS = 27  # of the largest bitmap, 16 MB


@dataclass(frozen=True)
class Settings:
    """Documents link at ``percent`` of 100 or more, on shingles of ``words`` words.

    ``frequent`` is the number of occurrences above which a token may count as frequent, and
    ``most_frequent`` how many frequent tokens are told apart at most (the heaviest): both decide the
    order of tokens, never the result. ``block`` members are compared with each other at a time.
    """

    words: int = 5
    percent: int = 80
    frequent: int = 4
    most_frequent: int = 1 << 20
    single_level: int = 5
    block: int = 256
    postings_per_part: int = 250_000

    def overlap(self, n: int) -> int:
        """Least intersection that a set of n has with any set it links with."""
        return -(-n * self.percent // 100)

    def links(self, common, a, b):
        return 100 * common >= self.percent * (a + b - common)

    def levels(self, n: int) -> list[int]:
        """Powers of two between which the sizes of this set and its partners fall: for any two sets
        that link, the level of the larger one is among the levels of both."""
        top = n * 100 // self.percent
        return list(range(int(math.log2(max(1, self.overlap(n)))), int(math.log2(max(1, top))) + 1))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Shingler:
    """Sets of hashed shingles of texts given as UTF-8 bytes."""

    def __init__(self, words: int):
        self.words = words
        self.known = Remembered(xxhash.xxh3_64_intdigest, CACHE_ENTRIES)

    def tokens(self, text: bytes | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes: of all word windows, or of the whole sequence if it is shorter."""
        words = text.translate(LOWER).split() if text else []
        if not words:
            return np.zeros(0, dtype=U64)
        h = np.fromiter(map(self.known.__getitem__, words), dtype=U64, count=len(words))
        span = min(self.words, len(h))
        m = h[: len(h) - span + 1].copy()
        for k in range(1, span):
            m = m * U64(0x9E3779B97F4A7C15) + h[k : len(h) - span + 1 + k]
        return np.unique(mix(m + U64(span)))


def shingler(words: int) -> Shingler:
    return per_process(f"shingler:{words}", lambda: Shingler(words))


def set_id(tokens: np.ndarray) -> int:
    """Digest of a set, as a signed 64-bit number: documents with equal sets form one class."""
    return int(np.array([xxhash.xxh3_64_intdigest(tokens.tobytes())], dtype=U64).view(np.int64)[0])


def profile(tokens: np.ndarray) -> np.ndarray:
    """How many tokens of a set fall into each of 2^k slots, about three a slot: a twentieth of the set.

    The slots' smaller counts add up to an upper bound of the intersection of two sets.
    """
    slots = 1 << max(4, math.ceil(math.log2(max(1, len(tokens)) / 3)))
    return np.minimum(np.bincount((tokens & U64(slots - 1)).astype(np.int64), minlength=slots), 255).astype(np.uint8)


def most_common(p: np.ndarray, q: np.ndarray) -> int:
    """Upper bound of the intersection of the sets with these profiles; of two lengths the longer is folded."""
    p, q = p.astype(np.int64), q.astype(np.int64)
    if p.max() >= 255 or q.max() >= 255:  # cut off, so no bound
        return 1 << 60
    while len(p) != len(q):
        if len(p) > len(q):
            p = p[: len(p) // 2] + p[len(p) // 2 :]
        else:
            q = q[: len(q) // 2] + q[len(q) // 2 :]
    return int(np.minimum(p, q).sum())


def pack_gaps(sorted_values: np.ndarray) -> bytes:
    """Sorted numbers below 2^21 as gaps of one to three bytes: seven bits each, a high bit if more follow."""
    gaps = np.diff(sorted_values, prepend=0).astype(np.int64)
    width = 1 + (gaps >= 1 << 7) + (gaps >= 1 << 14)
    last = np.cumsum(width) - 1
    out = np.zeros(int(width.sum()), dtype=np.uint8)
    out[last] = gaps & 127
    for k in (1, 2):
        long = width > k
        out[last[long] - k] = 128 | ((gaps[long] >> (7 * k)) & 127)
    return out.tobytes()


def unpack_gaps(raw: bytes) -> np.ndarray:
    code = np.frombuffer(raw, dtype=np.uint8)
    last = np.flatnonzero(code < 128)
    width, gaps = np.diff(last, prepend=-1), code[last].astype(np.int64)
    for k in (1, 2):
        long = width > k
        gaps[long] += (code[last[long] - k].astype(np.int64) & 127) << (7 * k)
    return np.cumsum(gaps)


def _texts(batch):
    """The texts as bytes, a few at a time: a batch may be large, and is held by Arrow already."""
    column = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
    for i in range(0, len(column), TEXTS):
        yield from column.slice(i, TEXTS).to_pylist()


def measured(docs: DataFrame, extra: list[str], bits: int, s: Settings) -> DataFrame:
    """One row (doc_id, extra, n, cls, profile) for each document, the profile once a task, and rows (block, gaps, more) that count tokens.

    A token falls into one of 2 ** bits cells. Each task counts its tokens, the first of equal sets
    only, and sends cells as gaps and counts above one as pairs.
    """
    kinds = dict(docs.dtypes)
    own = ", ".join(f"`{c}` {kinds[c]}" for c in ["doc_id", *extra])

    def counted(held):
        cells, counts = np.unique(np.concatenate(held), return_counts=True)
        block = (cells >> U64(min(BLOCK_BITS, bits))).astype(np.int64)
        inside = (cells & U64((1 << min(BLOCK_BITS, bits)) - 1)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(block)) + 1
        for at in np.split(np.arange(len(cells)), cuts):
            often = np.flatnonzero(counts[at] > 1)
            more = np.column_stack([often, counts[at][often]]).astype(np.uint32)
            yield int(block[at[0]]), pack_gaps(inside[at]), more.tobytes()

    def count_batch(held, schema):
        rows = list(counted(held))
        empty = [pa.nulls(len(rows), schema.field(c).type) for c in ["doc_id", *extra]]
        blank = pa.nulls(len(rows), pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                *empty,
                blank,
                blank,
                pa.nulls(len(rows), pa.binary()),
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.binary()),
                pa.array([r[2] for r in rows], pa.binary()),
            ],
            ["doc_id", *extra, "n", "cls", "profile", "block", "gaps", "more"],
        )

    def run(batches):
        sh, seen, held, size, schema = shingler(s.words), set(), [], 0, None
        for b in batches:
            schema, ns, classes, profiles = b.schema, [], [], []
            for text in _texts(b):
                tokens = sh.tokens(text)
                ns.append(len(tokens))
                classes.append(set_id(tokens) if len(tokens) else None)
                new = len(tokens) > 0 and classes[-1] not in seen
                profiles.append(profile(tokens).tobytes() if new else None)
                if len(tokens) and classes[-1] not in seen:
                    seen.add(classes[-1])
                    held.append(tokens >> U64(64 - bits))
                    size += len(tokens)
                if size >= FLUSH:
                    yield count_batch(held, schema)
                    held, size = [], 0
            none = pa.nulls(b.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *[b.column(b.schema.get_field_index(c)) for c in ["doc_id", *extra]],
                    pa.array(ns, pa.int64()),
                    pa.array(classes, pa.int64()),
                    pa.array(profiles, pa.binary()),
                    none,
                    pa.nulls(b.num_rows, pa.binary()),
                    pa.nulls(b.num_rows, pa.binary()),
                ],
                ["doc_id", *extra, "n", "cls", "profile", "block", "gaps", "more"],
            )
        if held:
            yield count_batch(held, schema)

    slim = docs.select("doc_id", *extra, "text")
    return slim.mapInArrow(run, f"{own}, n long, cls long, profile binary, block long, gaps binary, more binary")


def frequent_cells(counts: DataFrame, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Cells (sorted) of frequent tokens and their levels, the power of two of the count.

    Counts cover all documents. At most ``s.most_frequent`` cells, the heaviest, are kept, so what
    goes to the driver and from there to the tasks is bounded whatever the corpus.
    """

    def run(key, t):
        block, total = key[0].as_py(), np.zeros(1 << BLOCK_BITS, dtype=np.int64)
        for gaps, more in zip(t.column("gaps").to_pylist(), t.column("more").to_pylist()):
            at = unpack_gaps(gaps)
            total[at] += 1
            often = np.frombuffer(more, dtype=np.uint32).reshape(-1, 2)
            total[at[often[:, 0]]] += often[:, 1].astype(np.int64) - 1
        found = np.flatnonzero(total > s.frequent)
        level = np.log2(total[found]).astype(np.int32)
        return pa.table({"cell": pa.array(found + (block << BLOCK_BITS), pa.int64()), "level": pa.array(level, pa.int32())})

    heavy = stored(counts.groupBy("block").applyInArrow(run, "cell long, level int"), "frequent")
    left, lowest = s.most_frequent, 99
    for level, n in heavy.groupBy("level").count().orderBy(F.col("level").desc()).collect():
        if n > left:
            break
        left, lowest = left - n, level
    table = heavy.filter(F.col("level") >= lowest).toArrow()
    cells, levels = (table.column(c).to_numpy() for c in ("cell", "level"))
    order = np.argsort(cells)
    return cells[order].astype(U64), levels[order].astype(np.uint8)


def signatures(tokens: np.ndarray, level: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Keys of single rare tokens, and of pairs of frequent tokens, of a set's prefix.

    Tokens are ordered by level (0 is rare), then hash. If two sets link, the prefix of either misses
    at most n - overlap(n) common tokens; so a prefix of one token more has a common one, and of
    frequent tokens dealt into classes, where up to one of a class may be common without a common
    pair, the prefix is extended until the tokens beyond the first of each class make up for it. The
    number of classes follows the level of the set's size, so that a class has about two tokens of
    the prefix. Sets below ``single_level`` are too small for that and give single tokens.
    """
    n = len(tokens)
    need = n - s.overlap(n) + 1
    h = mix(tokens)
    order = np.lexsort((h, level))
    h, rare = h[order], int((level == 0).sum())
    if rare >= need:
        return h[:need], h[:0]
    singles, pairs = [h[:rare]], []
    for g in s.levels(n):
        if g < s.single_level:
            pairs.append(mix(h[rare:need] + U64(g + 1)))
            continue
        often = h[rare:]
        cls = (often >> U64(20)) % U64(max(1, (1 << g) // 4))
        by = np.argsort(cls, kind="stable")
        first = np.concatenate([[True], cls[by][1:] != cls[by][:-1]])
        later = np.empty(len(often), dtype=np.int64)
        later[by] = ~first
        cut = int(np.searchsorted(np.cumsum(later), need - rare)) + 1
        by = by[by < cut]
        start = np.flatnonzero(np.concatenate([[True], cls[by][1:] != cls[by][:-1]]))
        size = np.diff(np.append(start, len(by)))
        place, value = np.arange(len(by)) - np.repeat(start, size), often[by]
        for k in range(1, int(size.max())):
            right = np.flatnonzero(place >= k)
            a, b = value[right - k], value[right]
            pairs.append(mix(np.minimum(a, b) * U64(3) + mix(np.maximum(a, b)) + U64(g)))
    return np.concatenate(singles), np.unique(np.concatenate(pairs))


def postings(docs: DataFrame, cells: np.ndarray, levels: np.ndarray, bits: int, part_bits: int, salts: int, s: Settings) -> DataFrame:
    """Rows (often, part, keys, sets): keys of one part of the key space, and the class of each.

    Singles are dealt by the head of their key, pairs by key and a salt, as the sets that share
    frequent tokens may be very many.
    """

    def packed(held, often):
        keys, classes = np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held])
        if often:
            salt = mix(classes.view(U64)) % U64(salts)
            part = (mix(keys + salt) >> U64(64 - part_bits)).astype(np.int64) if part_bits else np.zeros(len(keys), np.int64)
        else:
            part = (keys >> U64(64 - part_bits)).astype(np.int64) if part_bits else np.zeros(len(keys), np.int64)
            keys = (keys >> U64(64 - part_bits - KEY_BITS)) & U64((1 << KEY_BITS) - 1)
        order = np.argsort(part, kind="stable")
        out = []
        for at in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            k = keys[at]
            raw = k.tobytes() if often else (k & U64(0xFFFFFFFF)).astype(np.uint32).tobytes() + (k >> U64(32)).astype(np.uint8).tobytes()
            out.append((often, int(part[at[0]]), raw, classes[at].tobytes()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([o[0] for o in out], pa.bool_()),
                pa.array([o[1] for o in out], pa.int64()),
                pa.array([o[2] for o in out], pa.binary()),
                pa.array([o[3] for o in out], pa.binary()),
            ],
            ["often", "part", "keys", "sets"],
        )

    def run(batches):
        sh, seen, held, size = shingler(s.words), set(), {False: [], True: []}, 0
        for b in batches:
            for text in _texts(b):
                tokens = sh.tokens(text)
                if not len(tokens):
                    continue
                cls = set_id(tokens)
                if cls in seen:
                    continue
                seen.add(cls)
                level = np.zeros(len(tokens), dtype=np.uint8)
                if len(cells):
                    cell = tokens >> U64(64 - bits)
                    at = np.minimum(np.searchsorted(cells, cell), len(cells) - 1)
                    level = np.where(cells[at] == cell, levels[at], 0)
                for often, keys in zip((False, True), signatures(tokens, level, s)):
                    if len(keys):
                        held[often].append((keys, np.full(len(keys), cls, dtype=np.int64)))
                        size += len(keys)
                if size >= FLUSH // 2:
                    yield from (packed(x, o) for o, x in held.items() if x)
                    held, size = {False: [], True: []}, 0
        yield from (packed(x, o) for o, x in held.items() if x)

    return docs.select("text").mapInArrow(run, "often boolean, part long, keys binary, sets binary")


def candidates(packed: DataFrame) -> DataFrame:
    """(hub, cls, crowd): classes that share a key with the smallest class of that key, and whether
    some such key has more than these two."""

    def run(key, t):
        often, part = key[0].as_py(), key[1].as_py()
        keys, classes = [], []
        for raw, own in zip(t.column("keys").to_pylist(), t.column("sets").to_pylist()):
            c = np.frombuffer(own, dtype=np.int64)
            if often:
                k = np.frombuffer(raw, dtype=U64)
            else:
                k = np.frombuffer(raw, dtype=np.uint32, count=len(c)).astype(U64)
                k |= np.frombuffer(raw, dtype=np.uint8, offset=4 * len(c)).astype(U64) << U64(32)
            keys.append(k)
            classes.append(c)
        keys, classes = np.concatenate(keys), np.concatenate(classes)
        order = np.lexsort((classes, keys))
        keys, classes = keys[order], classes[order]
        fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (classes[1:] != classes[:-1])])
        keys, classes = keys[fresh], classes[fresh]
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        size = np.diff(np.append(start, len(keys)))
        hub, count = np.repeat(classes[start], size), np.repeat(size, size)
        show = np.ones(len(keys), dtype=bool) if often else count > 1
        named = keys.view(np.int64) if often else np.zeros(len(keys), dtype=np.int64)
        if not often and show.any():
            # the key itself is no longer needed: one row for each pair of this part
            pair = np.unique(np.column_stack([hub, classes, count > 2])[show & (classes != hub)], axis=0)
            hub, classes, count = pair[:, 0], pair[:, 1], pair[:, 2] + 2
            named, show = np.zeros(len(hub), dtype=np.int64), np.ones(len(hub), dtype=bool)
        return pa.table(
            {
                "often": pa.array(np.full(int(show.sum()), often)),
                "key": pa.array(named[show], pa.int64()),
                "hub": pa.array(hub[show], pa.int64()),
                "cls": pa.array(classes[show], pa.int64()),
                "crowd": pa.array(count[show] > 2),
            }
        )

    shape = "often boolean, key long, hub long, cls long, crowd boolean"
    raw = stored(packed.groupBy("often", "part").applyInArrow(run, shape), "buckets")
    frequent = raw.filter("often")
    # salted parts of one key meet here, as minima and counts
    keys = frequent.groupBy("key").agg(F.min("hub").alias("first"), F.max("cls").alias("last"), F.count(F.lit(1)).alias("n"))
    merged = frequent.join(keys.filter("first != last"), "key").select(
        F.col("first").alias("hub"), "cls", (F.col("n") > 2).alias("crowd")
    )
    both = raw.filter("not often").select("hub", "cls", "crowd").unionByName(merged.filter("cls != hub"))
    return stored(both.groupBy("hub", "cls").agg(F.max("crowd").alias("crowd")), "candidates")


def possible(pairs: DataFrame, profiles: DataFrame, s: Settings) -> DataFrame:
    """(hub, cls, good, least) of ``pairs`` (hub, cls, na, nb): whether their profiles allow a link, and
    the least distance that these allow."""

    def run(batches):
        for b in batches:
            na, nb = (b.column(i).to_numpy() for i in (2, 3))
            sides = [[np.frombuffer(x, dtype=np.uint8) for x in b.column(i).to_pylist()] for i in (4, 5)]
            bound = np.array([most_common(p, q) for p, q in zip(*sides)], dtype=np.int64)
            bound = np.minimum(bound, np.minimum(na, nb))
            least = 1.0 - bound / np.maximum(na + nb - bound, 1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(s.links(bound, na, nb)), pa.array(least)], ["hub", "cls", "good", "least"]
            )

    both = (
        pairs.join(profiles.toDF("hub", "pa"), "hub")
        .join(profiles.toDF("cls", "pb"), "cls")
        .select("hub", "cls", "na", "nb", "pa", "pb")
    )
    return both.mapInArrow(run, "hub long, cls long, good boolean, least double")


def spot_of(column: str | Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(1 << bits))


def with_sets(docs: DataFrame, classes: DataFrame, rows: DataFrame, s: Settings) -> DataFrame:
    """``rows`` (cls and others) with the ``tokens`` of each class, computed again from the text of the
    document that stands for it. Sets meet their rows by class and id, so copies of one text that come
    through beside that document don't meet in one task.

    Which documents are read goes to the tasks as a bitmap with 64 bits for each one wanted, or as many
    as the largest bitmap has, so few others come through. Where that has fewer than eight, texts
    meet the wanted ids in a join instead.
    """
    rows = stored(rows.join(classes.select("cls", "rep"), "cls"), "wanted")
    wanted = stored(rows.select("rep").distinct(), "wanted-ids")
    count = wanted.count()
    bits = min(SPOT_BITS, max(15, math.ceil(math.log2(64 * max(1, count)))))
    slim, bitmap = docs.select("text", "doc_id"), None
    if 8 * count > 1 << SPOT_BITS:
        slim = slim.join(wanted, same(F.col("doc_id"), F.col("rep")), "left_semi")
    else:
        slim = slim.withColumn("spot", spot_of("doc_id", bits))
        pages = (
            wanted.select((spot_of("rep", bits) + 1).alias("spot"))
            .groupBy(F.bitmap_bucket_number("spot").alias("page"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
            .collect()
        )
        bitmap = np.zeros((1 << bits) // 8, dtype=np.uint8)
        for page, raw in pages:
            bitmap[(page - 1) * 4096 : page * 4096] = np.frombuffer(bytes(raw), dtype=np.uint8)

    def run(batches):
        sh = shingler(s.words)
        for b in batches:
            if bitmap is not None:
                spot = b.column(2).to_numpy()
                b = b.take(pa.array(np.flatnonzero((bitmap[spot >> 3] >> (spot & 7)) & 1)))
            for i in range(0, b.num_rows, TEXTS):
                part = b.slice(i, TEXTS)
                found = [sh.tokens(t) for t in _texts(part)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(1),
                        pa.array([set_id(t) for t in found], pa.int64()),
                        pa.array([t.tobytes() for t in found], pa.binary()),
                    ],
                    ["rep", "cls", "tokens"],
                )

    sets = slim.mapInArrow(run, f"rep {dict(docs.dtypes)['doc_id']}, cls long, tokens binary").alias("t")
    met = (F.col("w.cls") == F.col("t.cls")) & same(F.col("w.rep"), F.col("t.rep"))
    return rows.alias("w").join(sets, met).select("w.*", "tokens").drop("rep")


def compared(docs: DataFrame, classes: DataFrame, pairs: DataFrame, s: Settings) -> DataFrame:
    """(hub, cls, far, linked) of ``pairs`` (hub, cls): exact Jaccard distance, and whether they link."""
    sizes = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("n"))
    dealt = pairs.join(sizes, "hub").select(
        "hub", "cls", F.pmod(F.xxhash64("cls"), F.ceil(F.col("n") / s.block)).cast("int").alias("part")
    )
    rows = dealt.select("hub", "part", F.lit(1).alias("kind"), "cls").unionByName(
        dealt.select("hub", "part", F.lit(0).alias("kind"), F.col("hub").alias("cls")).distinct()
    )

    def run(batches):
        for key, t in sorted_runs(batches, ["hub", "part"]):
            sets = [np.frombuffer(x, dtype=U64) for x in t.column("tokens").to_pylist()]
            kind, own = t.column("kind").to_pylist(), t.column("cls").to_pylist()
            hub, out = sets[0], {}
            for tokens, k, c in zip(sets, kind, own):
                if k:
                    at = np.minimum(np.searchsorted(hub, tokens), len(hub) - 1)
                    common = int((hub[at] == tokens).sum())
                    out[c] = 1.0 - common / (len(hub) + len(tokens) - common), bool(s.links(common, len(hub), len(tokens)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key[0]] * len(out), pa.int64()),
                    pa.array(list(out), pa.int64()),
                    pa.array([v[0] for v in out.values()], pa.float64()),
                    pa.array([v[1] for v in out.values()], pa.bool_()),
                ],
                ["hub", "cls", "far", "linked"],
            )

    joined = with_sets(docs, classes, rows, s)
    return stored(
        joined.repartition("hub", "part")
        .sortWithinPartitions("hub", "part", "kind")
        .mapInArrow(run, "hub long, cls long, far double, linked boolean"),
        "compared",
    )


def open_pairs(t: pa.Table, size: np.ndarray, s: Settings) -> np.ndarray:
    """Which members of two blocks may link and are not in one component yet: neither the sizes nor the
    distances to the common hub rule it out."""
    roots = t.column("root").to_numpy()
    far = t.column("far").to_numpy(zero_copy_only=False)  # null, not a number: not known
    side = t.column("block").to_numpy()
    apart = 1.0 - s.percent / 100 + 1e-9
    maybe = np.triu(roots[:, None] != roots[None, :], 1)
    if side.min() != side.max():
        maybe &= side[:, None] != side[None, :]
    maybe &= np.minimum.outer(size, size) * 100 >= np.maximum.outer(size, size) * s.percent
    with np.errstate(invalid="ignore"):
        maybe &= ~(np.abs(far[:, None] - far[None, :]) > apart)
    return maybe


def open_members(t: pa.Table, s: Settings) -> np.ndarray:
    """Members of two blocks with an open pair that their profiles allow to link."""
    size = t.column("n").to_numpy()
    shape = [np.frombuffer(x, dtype=np.uint8) for x in t.column("profile").to_pylist()]
    use = np.zeros(len(size), dtype=bool)
    for i, j in zip(*np.nonzero(open_pairs(t, size, s))):
        if not (use[i] and use[j]) and s.links(min(most_common(shape[i], shape[j]), size[i], size[j]), size[i], size[j]):
            use[i] = use[j] = True
    return use


def block_links(t: pa.Table, s: Settings) -> list[tuple[int, int]]:
    """Links between different components among the members of two blocks, no more than it takes to join
    these components."""
    roots = t.column("root").to_numpy()
    sets = [np.frombuffer(x, dtype=U64) for x in t.column("tokens").to_pylist()]
    size = np.array([len(x) for x in sets], dtype=np.int64)
    maybe = open_pairs(t, size, s)
    use = np.flatnonzero(maybe.any(axis=0) | maybe.any(axis=1))
    if not len(use):
        return []
    row = np.repeat(np.arange(len(use)), size[use])
    _, token, seen = np.unique(np.concatenate([sets[i] for i in use]), return_inverse=True, return_counts=True)
    shared = seen[token] > 1
    number = np.cumsum(seen > 1) - 1
    row, token = row[shared], number[token[shared]]
    order = np.argsort(token, kind="stable")
    row, token = row[order], token[order]
    common = np.zeros((len(use), len(use)))
    width = 4096
    for low in range(0, int(token[-1]) + 1 if len(token) else 0, width):
        i, j = np.searchsorted(token, [low, low + width])
        member = np.zeros((len(use), width), dtype=np.float32)
        member[row[i:j], token[i:j] - low] = 1.0
        common += member @ member.T
    a, b = np.nonzero(maybe[np.ix_(use, use)])
    n = size[use]
    good = s.links(common[a, b].astype(np.int64), n[a], n[b])
    parent = {int(r): int(r) for r in roots[use]}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(a[good], b[good]):
        x, y = find(int(roots[use[i]])), find(int(roots[use[j]]))
        if x != y:
            parent[x] = y
            out.append((int(roots[use[i]]), int(roots[use[j]])))
    return out


def remaining_links(
    docs: DataFrame, classes: DataFrame, profiles: DataFrame, members: DataFrame, seen: DataFrame, roots: DataFrame, s: Settings
) -> DataFrame:
    """(a, b): links between components that the comparisons with hubs have left apart.

    Two classes that link share a key, and with it the key's hub. Members in the hub's own component
    are its core; the others are outsiders, near ones if the distance to the hub allows a link with
    something linked to the hub. Outsiders are compared with each other, and near ones with the core,
    block against block, so no task holds more than two blocks. Profiles come first; sets are fetched
    only for members that these leave with somebody to link with.
    """
    root = lambda c: F.coalesce(F.col(f"{c}.root"), F.col("m.hub" if c == "h" else "m.cls"))
    # without anything better, sizes alone keep two sets apart
    apart = 1.0 - F.least("c.n", "z.n") / F.greatest("c.n", "z.n")
    far_limit = 2 * (1.0 - s.percent / 100) + 1e-9
    family = (
        members.filter("crowd")
        .alias("m")
        .join(roots.alias("h"), F.col("h.node") == F.col("m.hub"), "left")
        .join(roots.alias("r"), F.col("r.node") == F.col("m.cls"), "left")
        .join(seen.alias("s"), (F.col("s.hub") == F.col("m.hub")) & (F.col("s.cls") == F.col("m.cls")), "left")
        .join(classes.alias("c"), F.col("c.cls") == F.col("m.cls"))
        .join(classes.alias("z"), F.col("z.cls") == F.col("m.hub"))
        .select(
            "m.hub",
            "m.cls",
            "c.n",
            "s.far",
            root("r").alias("root"),
            # the core beyond direct links may be farther from the hub: only distances rule pairs out
            F.when(root("h") == root("r"), 2).when(F.coalesce("s.least", apart) <= far_limit, 0).otherwise(1).alias("kind"),
            F.when(root("h") == root("r"), F.coalesce(F.col("s.linked"), F.lit(False))).alias("direct"),
        )
    )
    family = stored(family, "families")
    # core members that don't link with the hub themselves can be near any outsider
    at = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.greatest(F.lit(1), F.col("n") / 1000))), F.lit(0.0))
    sizes = family.groupBy("hub").agg(
        *[F.ceil(at(k) / s.block).cast("int").alias(f"b{k}") for k in range(3)],
        F.count_if(F.col("kind") != 2).alias("outsiders"),
        F.count_if((F.col("kind") == 2) & ~F.col("direct")).alias("loose"),
    )
    # with loose core members every outsider counts as near
    near = F.when(F.col("loose") > 0, F.col("b0") + F.col("b1")).otherwise(F.col("b0"))
    busy = sizes.withColumn("near", near).filter("outsiders >= 2 or (near > 0 and b2 > 0)")
    first = F.when(F.col("kind") == 0, F.lit(0)).when(F.col("kind") == 1, F.col("b0")).otherwise(F.col("b0") + F.col("b1"))
    wide = F.when(F.col("kind") == 0, F.col("b0")).when(F.col("kind") == 1, F.col("b1")).otherwise(F.col("b2"))
    outs, every = F.col("b0") + F.col("b1"), F.col("b0") + F.col("b1") + F.col("b2")
    upto = (
        F.when(F.col("kind") == 2, F.col("near"))  # a core block meets the near outsiders
        .when(F.col("block") < F.col("near"), every)
        .otherwise(outs)
    )
    dealt = (
        family.join(busy, "hub")
        .withColumn("block", (first + F.pmod(F.xxhash64("cls"), wide)).cast("int"))
        .withColumn("upto", upto)
        .filter("upto > 0")
        .select("hub", "cls", "n", "root", "far", "block", F.explode(F.sequence(F.lit(0), F.col("upto") - 1)).alias("other"))
        .select("hub", "cls", "n", "root", "far", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    )

    def narrow(batches):
        for _, t in sorted_runs(batches, ["hub", "i", "j"]):
            use = open_members(t, s)
            if use.any():
                yield from t.filter(pa.array(use)).drop_columns(["n", "profile"]).to_batches()

    columns = "hub long, cls long, root long, far double, block int, i int, j int"
    dealt = stored(
        dealt.join(profiles, "cls")
        .select("hub", "cls", "root", "far", "block", "i", "j", "n", "profile")
        .repartition("hub", "i", "j")
        .sortWithinPartitions("hub", "i", "j")
        .mapInArrow(narrow, columns),
        "blocks",
    )
    if dealt.isEmpty():
        return dealt.select(F.col("cls").alias("a"), F.col("root").alias("b"))

    def run(batches):
        for _, t in sorted_runs(batches, ["hub", "i", "j"]):
            found = block_links(t, s)
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    joined = with_sets(docs, classes, dealt, s)
    return (
        joined.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j").mapInArrow(run, "a long, b long").distinct()
    )


def near_groups(docs: DataFrame, s: Settings = Settings(), extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, extra, n_shingles, cls, root, component_id) for each row of ``docs`` (doc_id, text).

    ``cls`` tells equal sets, ``root`` the component of classes under links, ``component_id`` is the
    smallest doc_id of the component; all three are null, null and the row's own id for a set without
    shingles (null or empty text), which links with nothing. Null ids are never the smallest; rows
    may repeat; no rows give no rows. Classes are told apart by 64-bit digests.
    """
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    shingles = max(1.0, chars / 6)
    bits = min(MOST_BITS, max(BLOCK_BITS, math.ceil(math.log2(shingles)) + 1))
    part_bits = min(20, max(0, math.ceil(math.log2(0.25 * shingles / s.postings_per_part))))
    rows = stored(measured(docs, list(extra), bits, s), "shingled")
    found = rows.filter("block is null").select("doc_id", *extra, "n", "cls")
    shaped = rows.filter("profile is not null").select("cls", "profile")
    classes = found.filter("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"))
    classes = stored(classes, "classes")
    cells, levels = frequent_cells(rows.filter("block is not null").select("block", "gaps", "more"), s)
    salts = 1 + math.isqrt(classes.count()) // 64
    members = candidates(postings(docs, cells, levels, bits, part_bits, salts, s))

    size = classes.select("cls", "n")
    fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * s.percent
    pairs = members.join(size.toDF("hub", "na"), "hub").join(size.toDF("cls", "nb"), "cls").filter(fits)
    involved = members.select("cls").unionByName(members.select(F.col("hub").alias("cls"))).distinct()
    profiles = stored(
        shaped.join(involved, "cls", "left_semi").groupBy("cls").agg(F.first("profile").alias("profile")), "profiles"
    )
    stars = stored(possible(pairs.select("hub", "cls", "na", "nb"), profiles, s), "stars")
    exact = compared(docs, classes, stars.filter("good").select("hub", "cls"), s)
    seen = stars.join(exact, ["hub", "cls"], "left").select("hub", "cls", "far", "linked", F.coalesce("far", "least").alias("least"))
    roots = stored(components(seen.filter("linked").select(F.col("hub").alias("a"), F.col("cls").alias("b"))), "roots")
    more = stored(remaining_links(docs, classes, profiles, members, seen, roots, s), "more-links")
    if not more.isEmpty():
        higher = components(more)
        over = roots.alias("r").join(higher.alias("h"), F.col("r.root") == F.col("h.node"), "full")
        roots = stored(
            over.select(F.coalesce("r.node", "h.node").alias("node"), F.coalesce("h.root", "r.root").alias("root")), "roots"
        )
    named = classes.join(roots, F.col("cls") == F.col("node"), "left").select(
        "cls", "rep", F.coalesce("root", "cls").alias("root")
    )
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    of = named.join(least, "root").select(F.col("cls").alias("of_cls"), "root", "component_id")
    return found.join(of, F.col("cls") == F.col("of_cls"), "left").select(
        "doc_id",
        *extra,
        F.col("n").alias("n_shingles"),
        "cls",
        "root",
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The documents that stay when of each component only one does: the one with the smallest doc_id.

    Columns stay as they are. Texts without words link with nothing and stay, but of rows alike in
    id and text one stays.
    """
    mark = "text_mark"
    slim = docs.select("doc_id", "text", F.xxhash64("text").alias(mark))
    groups = near_groups(slim, s, (mark,))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(mark))
    linked = groups.filter("root is not null").groupBy("root").agg(F.min(order).alias("first")).select("first.*")
    stay = linked.select("doc_id", mark).unionByName(groups.filter("root is null").select("doc_id", mark).distinct())
    stay = stored(stay, "stay").alias("s")
    kept = (
        docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("mark"))
        .alias("d")
        .join(stay, same(F.col("d.id"), F.col("s.doc_id")) & (F.col("d.mark") == F.col(f"s.{mark}")), "left_semi")
    )
    return kept.dropDuplicates(["id", "mark"]).select("row.*")
