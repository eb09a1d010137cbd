"""Quality rules by robust multivariate outliers (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import BLANK, free_names, same, stored, text_of, words_of

# What counts as a symbol.
SYMBOLS = "#*$%&|<>"
#: Further marks that prose has few of; they count in the vector only.
MARKS = "!?@^~{}[]=\\"
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
#: Groups with fewer rows are drawn towards their language's estimate, the more the fewer they have.
SMALL_GROUP = 200
#: Rows that a scatter of four statistics takes.
LEAST_ROWS = 5
STEPS = 4
BINS_PER_UNIT = 16  # bins of the squared distance, per unit of its natural logarithm
#: Least standard deviation of each transformed statistic: narrower spreads are taken as this wide.
FLOORS = (0.1, 0.04, 0.06, 0.12)
#: Squared distance beyond which a document is rejected: far in the tail of chi-square with 4 degrees.
CUTOFF = 50.0
# Fixed value: median of chi-square with 4 degrees of freedom, P = 1/2.
CHI2_MEDIAN = 3.356694
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the array.

    Windows are sorted by their hash inside the row; a window equal to a neighbour there is repeated.
    Of the repeated windows in text order each adds the words the one before it didn't reach.
    """
    last = F.size(words) - 2
    grams = F.transform(
        F.sequence(F.lit(1), last),
        lambda i: F.struct(
            F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)).alias("h"), i.alias("at")
        ),
    )
    return F.when(last >= 2, F.sort_array(grams))


def repeated_starts(grams: Column) -> Column:
    """Sorted starts of the windows that are found again, from the sorted windows."""
    again = F.filter(
        grams,
        lambda g, i: (F.get(grams, i - 1)["h"].eqNullSafe(g["h"])) | (F.get(grams, i + 1)["h"].eqNullSafe(g["h"])),
    )
    return F.sort_array(F.transform(again, lambda g: g["at"]))


def covered(starts: Column) -> Column:
    """Words in three-word windows that start at the sorted places."""
    zero = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        starts,
        zero,
        lambda a, s: F.struct(s.alias("last"), (a["n"] + F.least(F.lit(3), s - a["last"])).alias("n")),
        lambda a: a["n"],
    )


def with_statistics(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with the statistics of the whole text, and the names of these columns (those of ``BASE``, and the further marks).

    Names that ``docs`` already has are avoided. A null text has no words.
    """
    names = free_names(docs, *BASE, "n_marks")
    words, grams, starts = free_names(docs, "words", "grams", "starts")
    text = text_of(text_col)
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(f"[^{BLANK}]"))
    staged = (
        docs.withColumn(words, words_of(text))
        .withColumn(grams, repeated_words(F.col(words)))
        .withColumn(starts, repeated_starts(F.col(grams)))
    )
    values = (
        F.size(words).cast("long"),
        F.length(F.translate(text, "\x20\x09\x0a\x0b\x0c\x0d", "")).cast("long"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        F.when(text.contains("\n"), F.size(lines) - F.size(F.array_distinct(lines))).otherwise(0).cast("long"),
        F.coalesce(covered(F.col(starts)), F.lit(0)).cast("long"),
        (F.length(text) - F.length(F.translate(text, MARKS, ""))).cast("long"),
    )
    return staged.select(*docs.columns, *[v.alias(n) for v, n in zip(values, names)]), names


def base_failed(names: Sequence[str]) -> Column:
    words, repeated = F.col(names[0]), F.col(names[4])
    return (words < MIN_WORDS) | (repeated * 100 > words * MAX_REPEATED)


def vector(names: Sequence[str]) -> list[Column]:
    """The transformed statistics: mean word length on a log scale, and the shares of marks,
    repeated lines and repeated words under a root, which steadies the spread of small counts."""
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat, n_marks = (F.col(n).cast("double") for n in names)
    words = F.greatest(n_words, F.lit(1.0))
    return [
        F.log((word_chars + 1) / words),
        F.sqrt((n_symbols + n_marks) / F.greatest(word_chars, F.lit(1.0))),
        F.sqrt(n_dup_lines / words),
        F.sqrt(n_repeat / words),
    ]


def _det(m: list[list[Column]]) -> Column:
    """Determinant by expansion along the first row; for the small matrices of this module."""
    if len(m) == 1:
        return m[0][0]
    total = None
    for j, x in enumerate(m[0]):
        part = x * _det([row[:j] + row[j + 1 :] for row in m[1:]])
        total = part if total is None else total + part if j % 2 == 0 else total - part
    return total


PAIRS = [(i, j) for i in range(4) for j in range(i, 4)]
MEANS = [f"m{i}" for i in range(4)]
INVERSE = [f"i{i}{j}" for i, j in PAIRS]
ESTIMATE = [f"m{i}" for i in range(4)] + [f"c{i}{j}" for i, j in PAIRS]


def estimate(sums: dict[str, Column], n: Column) -> list[Column]:
    """Mean and covariance, floored on the diagonal, from sums of x and of x * x'."""
    mean = [sums[f"m{i}"] / n for i in range(4)]
    out = [m.alias(f"m{i}") for i, m in enumerate(mean)]
    for i, j in PAIRS:
        value = sums[f"c{i}{j}"] / n - mean[i] * mean[j]
        if i == j:
            value = F.greatest(value, F.lit(0.0)) + FLOORS[i] ** 2
        out.append(value.alias(f"c{i}{j}"))
    return out


def with_inverse(estimates: DataFrame) -> DataFrame:
    """Estimates with their determinant and the inverse i00 .. i33 of their covariance."""
    c = [[F.col(f"c{min(i, j)}{max(i, j)}") for j in range(4)] for i in range(4)]
    minor = lambda i, j: [[c[a][b] for b in range(4) if b != j] for a in range(4) if a != i]
    told = estimates.withColumn("det", _det(c))
    return told.select("*", *[(_det(minor(i, j)) * float((-1) ** (i + j)) / F.col("det")).alias(f"i{i}{j}") for i, j in PAIRS])


def distance(x: list[Column], name: Callable[[str], str] = str) -> Column:
    """Squared Mahalanobis distance of x under the mean and inverse in the columns ``name(..)``."""
    off = [x[i] - F.col(name(f"m{i}")) for i in range(4)]
    total = F.lit(0.0)
    for i, j in PAIRS:
        total = total + off[i] * off[j] * F.col(name(f"i{i}{j}")) * (1.0 if i == j else 2.0)
    return total


def minimum_covariance(vectors: DataFrame, group: str, steps: int = STEPS) -> DataFrame:
    """Per group the mean and scatter of the half of its rows with the smallest determinant found.

    ``vectors`` has (group, x0 .. x3). From two starts, medians with spreads by quartiles and the
    plain estimate, concentration steps follow: take the half of the rows that is nearest under the
    estimate, estimate again; that never raises the determinant. The better start is taken, and its
    scatter is scaled so that the group's median distance is that of a normal distribution.

    A step is one aggregation: rows are summed by (group, start, bin of the distance), which groups
    of any size pass as partial sums, and bins are then added up to the one that completes the half.
    """
    x = [F.col(f"x{i}") for i in range(4)]
    moments = [F.sum(x[i]).alias(f"m{i}") for i in range(4)] + [F.sum(x[i] * x[j]).alias(f"c{i}{j}") for i, j in PAIRS]
    n = F.col("n")

    plain = vectors.groupBy(group).agg(F.count(F.lit(1)).alias("n"), *moments)
    plain = plain.select(group, F.lit(0).alias("start"), *estimate({e: F.col(e) for e in ESTIMATE}, n))
    # quartiles from counts of rounded values, exact to the rounding and the same for any partitioning
    steps_of = [F.round(x[i] * 256).cast("long") for i in range(4)]
    counted = (
        vectors.select(group, F.inline(F.array(*[F.struct(F.lit(i).alias("k"), steps_of[i].alias("v")) for i in range(4)])))
        .groupBy(group, "k", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    over = Window.partitionBy(group, "k")
    upto = F.sum("n").over(over.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.withColumn("upto", upto).withColumn("all", F.sum("n").over(over))
    quartile = lambda p: F.min(F.when(F.col("upto") >= F.col("all") * p, F.col("v"))) / 256.0
    by_k = ranked.groupBy(group, "k").agg(quartile(0.25).alias("q1"), quartile(0.5).alias("q2"), quartile(0.75).alias("q3"))
    one = lambda k, c: F.max(F.when(F.col("k") == k, c))
    robust = by_k.groupBy(group).agg(
        F.lit(1).alias("start"),
        *[one(i, F.col("q2")).alias(f"m{i}") for i in range(4)],
        *[
            (one(i, F.pow((F.col("q3") - F.col("q1")) / 1.349, 2)) + FLOORS[i] ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}")
            for i, j in PAIRS
        ],
    )
    now = stored(with_inverse(plain.unionByName(robust)), "mcd-start")

    def binned(estimates: DataFrame) -> DataFrame:
        """Sums of the rows of each bin of the distance, with the rows up to and of all bins."""
        step = F.floor(F.log(F.greatest(distance(x), F.lit(1e-6))) * BINS_PER_UNIT).cast("int")
        joined = vectors.alias("v").join(estimates.alias("e"), same(F.col(f"v.{group}"), F.col(f"e.{group}")))
        sums = (
            joined.select(F.col(f"v.{group}").alias(group), "start", step.alias("bin"), *x)
            .groupBy(group, "start", "bin")
            .agg(F.count(F.lit(1)).alias("n"), *moments)
        )
        own = Window.partitionBy(group, "start")
        ahead = F.sum("n").over(own.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)) - n
        return sums.withColumn("ahead", ahead).withColumn("all", F.sum("n").over(own))

    half = F.floor((F.col("all") + 4 + 1) / 2)
    for k in range(steps):
        nearest = binned(now).filter(F.col("ahead") < half)
        sums = nearest.groupBy(group, "start").agg(F.sum("n").alias("n"), *[F.sum(e).alias(e) for e in ESTIMATE])
        now = stored(with_inverse(sums.select(group, "start", *estimate({e: F.col(e) for e in ESTIMATE}, n))), f"mcd-{k}")
    best = Window.partitionBy(group).orderBy("det", "start")
    chosen = now.withColumn("place", F.row_number().over(best)).filter("place = 1").drop("place")
    medians = (
        binned(chosen)
        .filter((F.col("ahead") * 2 < F.col("all")) & ((F.col("ahead") + n) * 2 >= F.col("all")))
        .groupBy(group)
        .agg((F.exp((F.min("bin") + 1.0) / BINS_PER_UNIT) / CHI2_MEDIAN).alias("scale"))
    ).alias("s")
    # scatter is never scaled down: where most rows sit at one point, the floors decide
    scale = F.greatest(F.col("scale"), F.lit(1.0))
    return (
        chosen.alias("e")
        .join(medians, same(F.col(f"e.{group}"), F.col(f"s.{group}")))
        .select(
            f"e.{group}",
            *MEANS,
            *[(F.col(c) * scale).alias(c) for c in ESTIMATE[4:]],
            *[(F.col(i) / scale).alias(i) for i in INVERSE],
        )
    )


def shrunk(own: DataFrame, weight: str) -> DataFrame:
    """Estimates of groups, and of what they are drawn to in columns ``to_..``, joined with the group's
    ``weight`` from 0 to 1: mean and scatter of the mixture of both, whose scatter holds the way
    between the two means, so that a group far from its language isn't rejected for that."""
    w = F.col(weight)
    both = F.col("m0").isNotNull() & F.col("to_m0").isNotNull()
    mixed = lambda c: F.col(c) * w + F.col(f"to_{c}") * (F.lit(1.0) - w)
    way = [F.col(f"m{i}") - F.col(f"to_m{i}") for i in range(4)]
    one = lambda c, value: F.when(both, value).otherwise(F.coalesce(F.col(c), F.col(f"to_{c}"))).alias(c)
    return with_inverse(
        own.select(
            "g",
            *[one(m, mixed(m)) for m in MEANS],
            *[one(f"c{i}{j}", mixed(f"c{i}{j}") + w * (F.lit(1.0) - w) * way[i] * way[j]) for i, j in PAIRS],
        )
    ).select("g", *MEANS, *INVERSE)


def _measured(docs: DataFrame, group: Sequence[str]) -> tuple[DataFrame, list[str], str, str, str]:
    """``docs`` with statistics, group key, base verdict and the key's first part; names of the
    statistics and of these three."""
    key, failed, wide = free_names(docs, "group", "base_failed", "language")
    measured, names = with_statistics(docs)
    parts = [
        F.concat(F.when(F.col(c).isNull(), "-").otherwise("+"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("\x1f"))
        for c in group
    ]
    keyed = measured.withColumn(key, F.concat(*parts)).withColumn(wide, parts[0] if parts else F.lit(""))
    return keyed.withColumn(failed, base_failed(names)), names, key, failed, wide


def _estimates(rows: DataFrame, names: list[str], key: str, failed: str, wide: str, small: int, steps: int) -> DataFrame:
    """(g, mean and inverse) for each group of the stored ``rows``, learned from what passes the base rules.

    Groups of ``small`` rows stand for themselves. Smaller ones are drawn to the estimate of all rows
    with the same first part of the key, the language; those of under ``LEAST_ROWS`` take that alone.
    """
    learned = rows.filter(~F.col(failed)).select(
        F.col(key).alias("g"), F.col(wide).alias("l"), *[v.alias(f"x{i}") for i, v in enumerate(vector(names))]
    )
    counted = learned.groupBy("g", "l").agg(F.count(F.lit(1)).alias("n"))
    alike = counted.groupBy("l").agg(F.sum("n").alias("of_l"), F.count(F.lit(1)).alias("groups"), F.min("n").alias("least"))
    # a language is estimated where one of its groups is drawn to it
    asked = (F.col("least") < small) & (F.col("groups") > 1) & (F.col("of_l") >= LEAST_ROWS)
    sizes = stored(
        counted.join(alike, "l").select(
            "g",
            "n",
            F.when(F.col("n") >= LEAST_ROWS, F.concat(F.lit("g"), F.col("g"))).alias("own"),
            F.when(asked, F.concat(F.lit("l"), F.col("l"))).alias("to"),
            (F.col("n") < small).alias("drawn"),
        ),
        "quality-groups",
    )
    levels = F.filter(F.array("own", "to"), lambda e: e.isNotNull())
    named = learned.join(sizes.select("g", levels.alias("levels")), "g")
    vectors = stored(named.select(F.explode("levels").alias("e"), *[f"x{i}" for i in range(4)]), "quality-vectors")
    estimates = stored(minimum_covariance(vectors, "e", steps).select("e", *ESTIMATE), "quality-levels")
    to = estimates.select(*[F.col(c).alias(f"to_{c}") for c in estimates.columns])
    both = (
        sizes.join(estimates, F.col("own") == F.col("e"), "left")
        .join(to, F.col("drawn") & (F.col("to") == F.col("to_e")), "left")
        .filter(F.col("m0").isNotNull() | F.col("to_m0").isNotNull())
        .withColumn("weight", F.col("n") / F.lit(float(small)))
    )
    return stored(shrunk(both, "weight"), "quality-estimates")


def _with_verdict(rows: DataFrame, table: DataFrame, names: list[str], key: str, failed: str, cutoff: float) -> tuple[DataFrame, str]:
    name = dict(zip(["g", *MEANS, *INVERSE, "kept"], free_names(rows, "of", *MEANS, *INVERSE, "kept")))
    table = table.select(*[F.col(c).alias(name[c]) for c in table.columns])
    far = F.coalesce(distance(vector(names), name.get), F.lit(0.0))
    joined = rows.join(table, F.col(key) == F.col(name["g"]), "left")
    # one expression over both sides, so that no part of a filter on it moves below the join, where
    # the statistics would be worked out again inside the condition
    return joined.withColumn(name["kept"], F.when(F.col(failed), False).otherwise(far <= cutoff)), name["kept"]


def judged(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    group: Sequence[str] = ("lang", "source"),
    cutoff: float = CUTOFF,
    small: int = SMALL_GROUP,
    steps: int = STEPS,
) -> tuple[DataFrame, list[str]]:
    """The columns ``keep``, the base statistics, ``base_failed`` and ``kept``; and the names of these seven.

    Estimates are learned per ``group`` from rows that pass the base rules; those of groups with fewer
    than ``small`` such rows are drawn to the estimate of the group's first column, the language. With
    fewer than ``LEAST_ROWS`` such rows in a whole language there is no verdict beside the base rules.
    Nothing is learned across languages. A document is
    kept if it passes the base rules and its squared distance is at most ``cutoff``. Null texts have no
    words and fail the base rules; nulls in ``group`` form groups; the verdict depends on a row's own
    values and its group, so ids may be null or repeated. No rows give no rows.
    """
    measured, names, key, failed, wide = _measured(docs, group)
    rows = stored(measured.select(*keep, *names, key, failed, wide), "quality-rows")
    table = _estimates(rows, names, key, failed, wide, small, steps)
    found, kept = _with_verdict(rows, table, names, key, failed, cutoff)
    return found.select(*keep, *names[:5], failed, kept), [*names[:5], failed, kept]


def kept_documents(
    docs: DataFrame,
    group: Sequence[str] = ("lang", "source"),
    cutoff: float = CUTOFF,
    small: int = SMALL_GROUP,
    steps: int = STEPS,
) -> DataFrame:
    """The documents that the rules keep, with their columns as they were.

    Statistics are computed twice, to learn from and to judge by, which costs less than a copy of the texts.
    """
    measured, names, key, failed, wide = _measured(docs, group)
    rows = stored(measured.select(*names, key, failed, wide), "quality-rows")
    table = _estimates(rows, names, key, failed, wide, small, steps)
    found, kept = _with_verdict(measured, table, names, key, failed, cutoff)
    return found.filter(F.col(kept)).select(*docs.columns)
