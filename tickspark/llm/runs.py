"""Stretches of a text whose words repeat with a period, found by seed and extend on diagonals."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import words_of

LEAST = 24  # words a run has at least
TIMES = 3  # periods a run has at least
CHUNK = 1 << 20  # bytes of a text that are split into words at a time
FLUSH = 1 << 25  # bytes of collapsed text in one Arrow batch

# An odd multiplier for rolling hashes modulo 2^64, its inverse, and the steps of a 64-bit mixer.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def word_chunks(data: bytes, size: int = CHUNK):
    """The words of a text, in lists: the text is cut at blanks some ``size`` bytes apart."""
    at = 0
    while at < len(data):
        cut = _BLANK.search(data, at + size)
        end = cut.start() if cut else len(data)
        yield data[at:end].split()  # bytes split at exactly the blanks of the contract
        at = end


def word_numbers(data: bytes) -> np.ndarray:
    """A number for each word of the text, equal for equal words."""
    known: dict[bytes, int] = {}
    parts = [
        np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int32, count=len(words))
        for words in word_chunks(data)
    ]
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.int32)


def guaranteed(period: int, least: int = LEAST, times: int = TIMES) -> int:
    """Words in a row that equal the word one period on, in any run of this period."""
    return max(least - period, (times - 1) * period)


def _levels(count: int, least: int, times: int):
    """(low, k): periods from ``low`` up to below 2 * low, and the longest gram all their runs have as seed."""
    low = 1
    while max(least, times * low) <= count:
        yield low, min(guaranteed(q, least, times) for q in range(low, min(2 * low, low + least)))
        low *= 2


def _stretch(ids: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The widest [first, last) around ``at`` in which every word equals the one ``lag`` further on."""
    last, step, count = at, 64, len(ids) - lag
    while last < count:
        same = ids[last : min(last + step, count)] == ids[last + lag : min(last + step, count) + lag]
        if not same.all():
            last += int(same.argmin())
            break
        last, step = last + len(same), min(2 * step, CHUNK)
    first, step = at, 64
    while first > 0:
        low = max(0, first - step)
        same = ids[low:first] == ids[low + lag : first + lag]
        if not same.all():
            first -= int(same[::-1].argmin())
            break
        first, step = low, min(2 * step, CHUNK)
    return first, last


def runs_of(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period.

    A run of period q has at least k = ``guaranteed`` equal words at the lag q, so some k-gram occurs both
    there and q words on. Periods are taken in classes [low, 2 * low), with the k that all of a class have;
    k >= q, so between those two places the gram can't occur without q having a shorter period inside, and
    neighbouring occurrences are all the pairs needed: there are no more pairs than words. The smallest k
    indexes the text once; longer grams are looked up only where that one repeats. A table of the word up to
    which each lag has been covered leaves one extension for each run.
    """
    if times < 3:
        raise ValueError("seeds are as long as their period only from three periods on")
    count, found = len(ids), []
    levels = list(_levels(count, least, times))
    if not levels:
        return found
    seed = min(k for _, k in levels)
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) + np.uint64(1)
        for shift, factor in zip((30, 27), MIX):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        power = np.full(count, BASE, dtype=np.uint64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        prefix = np.zeros(count + 1, dtype=np.uint64)
        np.cumsum(x * power, out=prefix[1:])
        back = np.full(count, INVERSE, dtype=np.uint64)
        back[0] = 1
        np.multiply.accumulate(back, out=back)

        def grams(at: np.ndarray, k: int) -> np.ndarray:
            return (prefix[at + k] - prefix[at]) * back[at]

        every = (prefix[seed:] - prefix[:-seed]) * back[: count - seed + 1]
        order = np.argsort(every, kind="stable")
        again = every[order[1:]] == every[order[:-1]]
        repeated = np.zeros(len(every), dtype=bool)
        repeated[order[1:][again]] = True
        repeated[order[:-1][again]] = True
        places = np.flatnonzero(repeated)
        for low, k in levels:
            places_k = places[places + k <= count]
            if len(places_k) < 2:
                continue
            gram = grams(places_k, k)
            order = np.argsort(gram, kind="stable")
            gram, spot = gram[order], places_k[order]
            lag = spot[1:] - spot[:-1]
            pair = (gram[1:] == gram[:-1]) & (lag >= low) & (lag < 2 * low)
            first, lag = spot[:-1][pair], lag[pair]
            order = np.lexsort((first, lag))
            first, lag = first[order], lag[order]
            edges = np.flatnonzero(np.r_[True, lag[1:] != lag[:-1]]) if len(lag) else []
            covered: dict[int, int] = {}
            for i, j in zip(edges, [*edges[1:], len(lag)]):
                period, seeds = int(lag[i]), first[i:j]
                at = 0
                while at < len(seeds):
                    start, last = _stretch(ids, int(seeds[at]), period)
                    length = last - start + period
                    if length >= max(least, times * period) and start >= covered.get(period, 0):
                        found.append((start, length, period))
                    covered[period] = max(last, int(seeds[at]) + 1)
                    at = int(np.searchsorted(seeds, covered[period]))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(data: bytes, runs: list[tuple[int, int, int]], count: int) -> bytes:
    """The words joined by single spaces, without those after the first period of a run."""
    if not runs:
        return b" ".join(w for words in word_chunks(data) for w in words)
    edge = np.zeros(count + 1, dtype=np.int32)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    parts, at = [], 0
    for words in word_chunks(data):
        parts += [w for w, k in zip(words, keep[at : at + len(words)].tolist()) if k]
        at += len(words)
    return b" ".join(parts)


def periodic_runs(
    docs: DataFrame, least: int = LEAST, times: int = TIMES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_words, runs array<struct<start, length, period>>, collapsed) for every row.

    A run is a stretch of consecutive words with smallest period q, at least ``least`` words and ``times``
    periods long (three or more), which no neighbouring word extends. ``collapsed`` is the text without what
    runs repeat. Documents don't depend on each other, so each is one task's work and nothing is shuffled;
    a text is split piece by piece, and what is held grows with its words: some forty bytes each.

    Null texts are empty; an empty text has no words, no runs, and collapses to nothing. Repeated rows and
    null ids stay as they are, no rows give no rows; other columns are not read.
    """

    def run(batches):
        def made(ids, counts, runs, texts):
            kind = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
            rows = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs]
            columns = [pa.concat_arrays(ids), pa.array(counts, pa.int64()), pa.array(rows, pa.list_(kind)), pa.array(texts, pa.string())]
            return pa.RecordBatch.from_arrays(columns, [id_col, "n_words", "runs", "collapsed"])

        for b in batches:
            names = b.schema.get_field_index(id_col), b.schema.get_field_index(text_col)
            ids, counts, runs, texts, held = [], [], [], [], 0
            for spot, value in enumerate(b.column(names[1])):
                data = (value.as_py() or "").encode()
                numbers = word_numbers(data)
                own = runs_of(numbers, least, times)
                ids.append(b.column(names[0]).slice(spot, 1))
                counts.append(len(numbers))
                runs.append(own)
                texts.append(collapsed(data, own, len(numbers)).decode())
                held += len(data)
                if held >= FLUSH:
                    yield made(ids, counts, runs, texts)
                    ids, counts, runs, texts, held = [], [], [], [], 0
            if ids:
                yield made(ids, counts, runs, texts)

    slim = docs.select(id_col, text_col)
    kind = dict(slim.dtypes)[id_col]
    found = "array<struct<start: bigint, length: bigint, period: bigint>>"
    return slim.mapInArrow(run, f"`{id_col}` {kind}, n_words long, runs {found}, collapsed string")


def strongest(runs: Column) -> Column:
    """Of runs in order of start and period the one with the greatest length by period, the first of equals."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    further = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(runs, none, lambda best, r: F.when(further(best, r), r).otherwise(best))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which a tenth of the documents, by crc32 of the id, end in a repeated stretch.

    With h the crc32 of the decimal id and g = h div 10, a document with h mod 10 = 0 and n > 0 words has
    every word from a = g mod n on replaced by that at a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8).
    Documents without id are left as they are.
    """
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(hashed % 10 == 0, words_of(F.col("text")))
    split = docs.select("doc_id", "text", F.floor(hashed / 10).alias("_g"), words.alias("_w"))
    n = F.size("_w")
    a = (F.col("_g") % n).cast("int")
    p = (1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int")
    placed = split.withColumn("_a", F.when(n > 0, a)).withColumn("_p", p)
    rest = n - F.col("_a")
    tail = F.flatten(F.array_repeat(F.slice("_w", F.col("_a") + 1, F.col("_p")), F.ceil(rest / F.col("_p")).cast("int")))
    planted = F.array_join(F.concat(F.slice("_w", F.lit(1), F.col("_a")), F.slice(tail, F.lit(1), rest)), " ")
    return placed.select("doc_id", F.when(F.col("_a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))
