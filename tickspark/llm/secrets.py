"""Secret scans: fixed patterns, and character Markov models (DataFrame functions only)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import free_names, text_of

# The base patterns, what must be in a text for each, and the least lengths.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # a run of hex digits is always matched whole, so short runs needn't be
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KINDS = ("assign", "access", "hex", "random")
# Characters that keys and tokens are written in, and the runs of them that are judged.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
LEAST_RUN = 20
RUN = rf"[A-Za-z0-9+/_=-]{{{LEAST_RUN},}}"
SPANS = "array<struct<start:long,rank:int,stop:long>>"
PLACEHOLDER = "[SECRET]"


@dataclass(frozen=True)
class Settings:
    """``samples`` values of each label are made to train on; ordinary ones also come from the words of
    all documents, which count for half of them however many they are. A run is a secret if its
    log-likelihood ratio is at least ``least``, and at least ``least_each`` per character."""

    samples: int = 4000
    least: float = 14.0
    least_each: float = 0.5
    seed: int = 13


CORPUS = "corpus"
SPAN_BLOCK = 256  # spans or matches that are put together at a time
# Everyday parts of names in programs, for ordinary samples beside the corpus's own words.
NAME_PARTS = (
    "get set user account server connection timeout config path file name value index buffer stream module package "
    "version request response client session table column query update delete insert status message error handler "
    "service library system number string object array list parse format default local remote public private static "
    "final python spark count maximum minimum retry settings database report site local user bin usr home http"
).split()


def corpus_words(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all documents that consist of letters alone, 4 to 30, and how often they occur."""
    word = F.regexp_extract_all(text_of("text"), F.lit(r"(?<![A-Za-z0-9+/_=-])[A-Za-z]{4,30}(?![A-Za-z0-9+/_=-])"), F.lit(0))
    return docs.select(F.explode(word).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def default_samples(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Labelled samples (value, random, part, n): strings of digests in the usual spellings, and ordinary
    identifiers: everyday names, and every distinct word of the corpus in the ways identifiers join words,
    ``n`` times."""
    digest = F.sha2(F.concat(F.lit(f"{s.seed}:"), F.col("id").cast("string")), 256)
    spelled = F.array(
        F.regexp_replace(F.base64(F.unhex(digest)), "=+$", ""),
        F.substring(digest, 1, 40),
        F.translate(F.substring(F.upper(F.base64(F.unhex(digest))), 1, 24), "+/=", "749"),
        F.substring(F.translate(F.base64(F.unhex(digest)), "+/", "-_"), 1, 32),
    )
    random = docs.sparkSession.range(max(1, s.samples // 4)).select(F.explode(spelled).alias("value"), F.lit(True).alias("random"))
    parts, n = F.array(*[F.lit(x) for x in NAME_PARTS]), len(NAME_PARTS)
    at = lambda i: F.element_at(parts, (i % n + 1).cast("int"))
    usual = docs.sparkSession.range(s.samples // 2).select(at(F.col("id")).alias("a"), at(F.col("id") * 7 + F.floor(F.col("id") / n)).alias("b"))

    def joined(a: Column, b: Column) -> Column:
        return F.array(
            a,
            F.concat_ws("_", F.lower(a), F.lower(b)),
            F.concat(F.lower(a), F.initcap(b)),
            F.concat_ws("-", F.lower(a), b, (F.length(a) * 7 + F.length(b)).cast("string")),
            F.concat(F.lit("/"), F.lower(a), F.lit("/"), F.lower(b)),
            F.upper(F.concat_ws("_", a, b)),
        )

    names = (
        usual.select(F.explode(joined(F.col("a"), F.col("b"))).alias("value"))
        .distinct()
        .orderBy(F.xxhash64(F.lit(s.seed), "value"), "value")
        .limit(s.samples // 2)
        .withColumn("random", F.lit(False))
    )
    one = lambda frame, part: frame.select("value", "random", F.lit(part).alias("part"), F.lit(1).cast("long").alias("n"))
    word = F.col("word")
    corpus = corpus_words(docs).select(
        F.explode(joined(word, word)).alias("value"), F.lit(False).alias("random"), F.lit(CORPUS).alias("part"), "n"
    )
    return one(random, "digests").unionByName(one(names, "names")).unionByName(corpus)


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios of two first-order Markov models, random over ordinary, as a flat table:
    the ratio for character j after character i is at i * len(ALPHABET) + j.

    ``samples`` are (value, random); with ``n`` a value counts so often, and with ``part`` what is CORPUS
    counts in all for no more than the label's other values do. Only counts of character pairs come to the driver, at most
    len(ALPHABET)^2 for each label and part. Characters outside the alphabet are left out; without samples
    all ratios are 0.
    """
    value = F.col("value")
    pairs = F.transform(F.sequence(F.lit(1), F.length(value) - 1), lambda i: F.substring(value, i, F.lit(2)))
    n = F.col("n") if "n" in samples.columns else F.lit(1)
    part = F.col("part") if "part" in samples.columns else F.lit("")
    inside = f"^[{ALPHABET}]{{2}}$"
    counts = (
        samples.filter((F.length(value) >= 2) & F.col("random").isNotNull())
        .select("random", part.alias("part"), n.alias("n"), F.explode(pairs).alias("pair"))
        .filter(F.col("pair").rlike(inside))
        .groupBy("random", "part", "pair")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    at = {c: i for i, c in enumerate(ALPHABET)}
    size = len(ALPHABET)
    whole: dict[tuple, int] = {}
    for r in counts:
        whole[r["random"], r["part"]] = whole.get((r["random"], r["part"]), 0) + r["n"]
    others = {k: sum(v for (label, part), v in whole.items() if label == k and part != CORPUS) for k in (True, False)}
    seen = {True: [[0.0] * size for _ in at], False: [[0.0] * size for _ in at]}
    for r in sorted(counts, key=lambda r: (r["random"], r["part"], r["pair"])):
        bound = others[r["random"]] if r["part"] == CORPUS else 0
        scale = min(1.0, bound / whole[r["random"], CORPUS]) if bound else 1.0
        seen[r["random"]][at[r["pair"][0]]][at[r["pair"][1]]] += r["n"] * scale
    out = []
    for i in range(size):
        totals = {k: sum(rows[i]) + 0.5 * size for k, rows in seen.items()}
        for j in range(size):
            out.append(math.log((seen[True][i][j] + 0.5) / totals[True]) - math.log((seen[False][i][j] + 0.5) / totals[False]))
    return out


def _codes(value: Column) -> Column:
    """The characters' places in the alphabet, as an array: looking one up takes the same time anywhere."""
    return F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)


def _pairs(codes: Column, body) -> Column:
    """``body(first, second)`` of all neighbouring codes."""
    count = F.greatest(F.size(codes) - 1, F.lit(0))
    return F.zip_with(F.slice(codes, F.lit(1), count), F.slice(codes, F.lit(2), count), body)


def _score(table: Column, a: Column, b: Column) -> Column:
    return F.element_at(table, (a * len(ALPHABET) + b + 1).cast("int"))


def ratio(value: Column, model: list[float]) -> Column:
    """Sum of the model's ratios over the string's character pairs."""
    table = F.array(*[F.lit(float(x)) for x in model])
    total = lambda cs: F.aggregate(_pairs(cs, lambda a, b: _score(table, a, b)), F.lit(0.0), lambda t, x: t + x)
    return _let(_codes(value), total)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once for each use of the whole."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _widened(run: Column, start: Column, stop: Column) -> Column:
    """The stretch without separators at its ends, widened to the separators around it. A rest of
    the run of at most three characters behind one, and padding, count as part of the key."""
    part = F.substring(run, start + 1, stop - start)
    first = start + F.length(F.regexp_extract(part, "^[/_=-]*", 0))
    last = stop - F.length(F.regexp_extract(F.reverse(part), "^[/_=-]*", 0))
    ahead = F.reverse(F.substring(run, F.lit(1), first))
    behind = F.substring(run, last + 1, F.length(run))
    return F.struct(
        (first - F.length(F.regexp_extract(ahead, "^[A-Za-z0-9+]*(?:[/_-][A-Za-z0-9+]{0,3}$)?", 0))).alias("start"),
        (last + F.length(F.regexp_extract(behind, "^[A-Za-z0-9+]*(?:[/_-][A-Za-z0-9+]{0,3}(?==*$))?=*", 0))).alias("stop"),
    )


def stretches(run: Column, model: list[float], s: Settings) -> Column:
    """Parts of a run that are secrets, as an array of (start, stop) in it.

    One pass over the pairs' ratios, each less ``least_each``: a stretch begins where the sum was
    lowest and ends where it is highest, and is closed when the sum falls to zero or by ``least``, or
    at '=', which no key has inside. Names and paths around a key so count neither for nor against it,
    and a run may hold several. A run without such a stretch is judged as one whole.
    """
    table = F.array(*[F.lit(float(x)) for x in model])
    sign = ALPHABET.index("=")
    pair = lambda a, b: F.struct(_score(table, a, b).alias("r"), ((a == sign) | (b == sign)).alias("cut"))
    placed = lambda p, i: F.struct((i + 1).alias("at"), p["r"].alias("r"), p["cut"].alias("cut"))
    found = "array<struct<start:int,stop:int>>"
    state = lambda start, sum_, raw, top, top_raw, stop, all_, out: F.struct(
        start.alias("start"), sum_.alias("sum"), raw.alias("raw"), top.alias("top"), top_raw.alias("top_raw"),
        stop.alias("stop"), all_.alias("all"), out.alias("out"),
    )
    zero, none = F.lit(0.0), F.lit(0)
    keep = lambda a: F.when(
        a["top_raw"] >= s.least, F.concat(a["out"], F.array(F.struct(a["start"].alias("start"), a["stop"].alias("stop"))))
    ).otherwise(a["out"])

    def step(a, p):
        total, raw = a["sum"] + p["r"] - F.lit(s.least_each), a["raw"] + p["r"]
        over = p["cut"] | (total <= 0) | (total < a["top"] - F.lit(s.least))
        closed = state(p["at"], zero, zero, zero, zero, none, a["all"] + p["r"], keep(a))
        higher = state(a["start"], total, raw, total, raw, p["at"] + 1, a["all"] + p["r"], a["out"])
        lower = state(a["start"], total, raw, a["top"], a["top_raw"], a["stop"], a["all"] + p["r"], a["out"])
        return F.when(over, closed).when(total > a["top"], higher).otherwise(lower)

    def finish(a):
        wide = F.transform(keep(a), lambda x: _widened(run, x["start"], x["stop"]))
        like_key = lambda x: _let(
            F.substring(run, x["start"] + 1, x["stop"] - x["start"]),
            lambda part: (F.length(part) >= LEAST_RUN) & (part.rlike("[0-9+]") | part.rlike("[a-z][A-Z]")),
        )
        good = F.array_distinct(F.filter(wide, like_key))
        whole = F.struct(F.lit(0).alias("start"), F.length(run).alias("stop"))
        passes = a["all"] >= F.greatest(F.lit(s.least), F.length(run) * F.lit(s.least_each))
        return _let(good, lambda g: F.when((F.size(g) > 0) | ~passes, g).otherwise(F.array(whole)))

    start = state(none, zero, zero, zero, zero, none, zero, F.array().cast(found))
    judged = _let(_codes(run), lambda cs: F.aggregate(F.transform(_pairs(cs, pair), placed), start, step, finish))
    return F.when(run.rlike("[0-9+/=_-]") | run.rlike("[a-z][A-Z]"), judged).otherwise(F.array().cast(found))


def matched(text: Column, pattern: str, rank: int, part: int, good=None, inner=None) -> Column:
    """Spans of the pattern's leftmost matches that do not overlap and whose group ``part`` is ``good``;
    or, with ``inner``, the spans (start, stop) that it finds in each match.

    The text between matches and the matches take turns, so their lengths add up to the positions.
    """
    turns = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(part)).alias("part"),
    )
    nothing = F.array().cast(SPANS)
    zero = F.struct(F.lit(0).cast("long").alias("at"), nothing.alias("out"))

    def step(a, t):
        start = a["at"] + F.length(t["gap"])
        stop = start + F.coalesce(F.length(t["hit"]), F.lit(0))
        span = lambda x, y: F.struct(x.cast("long").alias("start"), F.lit(rank).alias("rank"), y.cast("long").alias("stop"))
        if inner is None:
            ok, spans = t["hit"].isNotNull() & good(t["part"]), F.array(span(start, stop))
        else:
            ok, spans = t["hit"].isNotNull(), F.transform(inner(t["hit"]), lambda x: span(start + x["start"], start + x["stop"]))
        return F.struct(
            stop.cast("long").alias("at"), F.when(ok, F.concat(a["out"], spans)).otherwise(a["out"]).alias("out")
        )

    # a block's spans are counted from its start, then moved to where it lies
    blocks = _let(turns, lambda ts: F.transform(_blocks(ts), lambda b: F.aggregate(b, zero, step)))
    move = lambda x, at: F.struct((x["start"] + at).alias("start"), x["rank"].alias("rank"), (x["stop"] + at).alias("stop"))
    lists = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPANS}>").alias("out"))
    joined = lambda a, b: F.struct(
        (a["at"] + b["at"]).alias("at"),
        F.concat(a["out"], F.array(F.transform(b["out"], lambda x: move(x, a["at"])))).alias("out"),
    )
    found = F.aggregate(blocks, lists, joined, lambda a: F.flatten(a["out"]))
    return F.when(text.rlike(pattern), found).otherwise(nothing)


def _blocks(items: Column) -> Column:
    """An array in slices, so that what is put together item by item stays short."""
    last = F.floor((F.greatest(F.size(items), F.lit(1)) - 1) / SPAN_BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(items, k * SPAN_BLOCK + 1, F.lit(SPAN_BLOCK)))


def with_spans(docs: DataFrame, model: list[float], s: Settings = Settings(), text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with arrays of the spans of each kind (code points, end exclusive), and these columns' names.

    A null or empty text has none. Runs are judged without what spans of base kinds cover of them.
    """
    names = free_names(docs, *KINDS)
    text = text_of(text_col)
    longer = lambda n: lambda part: F.length(part) >= n
    base = docs.select(
        *docs.columns,
        matched(text, ASSIGN, 0, 2, longer(ASSIGN_LEAST)).alias(names[0]),
        matched(text, ACCESS, 1, 0, longer(ACCESS_LEAST)).alias(names[1]),
        matched(text, HEX, 2, 0, longer(1)).alias(names[2]),
    )
    known = F.sort_array(F.concat(*[F.col(n) for n in names[:3]]))
    (rest,) = free_names(base, "rest")
    base = base.withColumn(rest, F.when(F.size(known) > 0, _blanked(text, known)).otherwise(text))
    runs = matched(F.col(rest), RUN, 3, 0, inner=lambda run: stretches(run, model, s))
    return base.select(*docs.columns, *names[:3], runs.alias(names[3])), names


def _spliced(text: Column, spans: Column, fill) -> Column:
    """The text with ``fill(end so far, span)`` in place of each of the sorted spans, which may overlap.

    A block of spans looks only at its own part of the text.
    """
    strings = F.array().cast("array<string>")
    part = lambda t, first, count: F.substring(t, (first + 1).cast("int"), F.greatest(count, F.lit(0)).cast("int"))

    def of_block(a, spans_of, piece):
        def step(x, span):
            gap = part(piece, x["at"] - a["at"], span["start"] - x["at"])
            return F.struct(
                F.greatest(x["at"], span["stop"]).alias("at"), F.concat(x["out"], F.array(gap, fill(x["at"], span))).alias("out")
            )

        zero = F.struct(a["at"].alias("at"), strings.alias("out"))
        return F.aggregate(spans_of, zero, step, lambda x: F.struct(x["at"].alias("at"), F.array_join(x["out"], "").alias("text")))

    def joined(a, b):
        stop = F.greatest(a["at"], F.array_max(F.transform(b, lambda x: x["stop"])))
        made = _let(part(text, a["at"], stop - a["at"]), lambda piece: of_block(a, b, piece))
        return _let(made, lambda m: F.struct(m["at"].alias("at"), F.concat(a["out"], F.array(m["text"])).alias("out")))

    rest = lambda a: F.concat(
        F.array_join(a["out"], ""), F.substring(text, (a["at"] + 1).cast("int"), F.length(text))
    )
    zero = F.struct(F.lit(0).cast("long").alias("at"), strings.alias("out"))
    return F.aggregate(_blocks(spans), zero, joined, rest)


def _blanked(text: Column, spans: Column) -> Column:
    """The text with blanks in place of the spans."""
    blanks = lambda at, x: F.repeat(F.lit(" "), F.greatest(x["stop"] - F.greatest(at, x["start"]), F.lit(0)).cast("int"))
    return _spliced(text, spans, blanks)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans by start, then kind, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    one = lambda x: F.concat_ws(
        ":", F.element_at(kinds, x["rank"] + 1), x["start"].cast("string"), x["stop"].cast("string")
    )
    return F.array_join(F.transform(F.sort_array(spans), one), ",")


def scan(docs: DataFrame, s: Settings = Settings(), samples: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """Train on ``samples`` (by default made from ``docs``) and add the spans of all kinds to ``docs``.

    Ids play no part, repeated rows are scanned alike, no rows give no rows.
    """
    return with_spans(docs, train(default_samples(docs, s) if samples is None else samples), s)


def redacted(docs: DataFrame, s: Settings = Settings(), samples: DataFrame | None = None) -> DataFrame:
    """``docs`` with every span replaced by a placeholder, overlapping spans by one; ``n_chars``, where
    there is such a column, is the new length. Other texts, null ones too, stay as they are."""
    found, names = scan(docs, s, samples)
    spans, new = free_names(found, "spans", "clean")
    text = F.col("text")
    # spans that overlap, and are so one stretch, get one placeholder
    mark = lambda at, x: F.when((x["start"] > at) | (at == 0), F.lit(PLACEHOLDER)).otherwise("")
    clean = F.when(F.size(spans) > 0, _spliced(text, F.col(spans), mark)).otherwise(text)
    marked = found.withColumn(spans, F.sort_array(F.concat(*[F.col(n) for n in names]))).withColumn(new, clean)
    hit = F.size(spans) > 0
    out = {"text": F.col(new), "n_chars": F.when(hit, F.length(new).cast("long")).otherwise(F.col("n_chars"))}
    return marked.select(*[out[c].alias(c) if c in out else F.col(c) for c in docs.columns])
