"""The operators against plain Python, over nulls, empty and long texts, ties, repeats and clashing names."""

import collections
import hashlib
import itertools
import math
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import documents, frame
from tickspark.llm import (
    ann,
    bpe,
    components,
    jaccard,
    mixing,
    quality_model,
    quality_rules,
    secrets,
    sharding,
    toxicity,
    warc,
)
from tickspark.session import scratch_path

ROWS = documents()
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS, extra=True).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def counted(rows):
    return collections.Counter(rows)


# ---- sharding -----------------------------------------------------------------------------------


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards(docs, shards):
    rows = sharding.shard_documents(docs, shards).collect()
    want = counted((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in ROWS)
    assert counted((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    per = collections.defaultdict(list)
    for r in rows:
        per[r.shard].append(r)
    sizes = [len(per[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(per) <= set(range(shards))
    share = counted(r[3] for r in ROWS)
    for s, own in per.items():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        for source, n in counted(r.source for r in own).items():
            assert abs(n - share[source] * len(own) / len(ROWS)) <= len(share)


def test_shards_are_the_same_for_any_partitioning(spark):
    got = [
        counted(map(tuple, sharding.shard_documents(frame(spark, ROWS[:150], parts=p), 5).select("doc_id", "shard", "slot").collect()))
        for p in (1, 6)
    ]
    assert got[0] == got[1]


def test_shards_on_disk_hold_every_document(spark, folder):
    sharding.write_shards(frame(spark, ROWS[:60] + [ROWS[2]] * 3), f"{folder}/s", 4)
    rows = spark.read.parquet(f"{folder}/s").collect()
    assert counted((r.doc_id, r.text) for r in rows) == counted((r[0], r[1]) for r in ROWS[:60] + [ROWS[2]] * 3)


# ---- mixing -------------------------------------------------------------------------------------


def water_fill(sizes, weights, most):
    capped = set()
    total = sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        open_ = [s for s in sizes if s not in capped]
        rate = left / sum(weights[s] for s in open_) if open_ else 0
        more = {s for s in open_ if weights[s] * rate > most * sizes[s]}
        if not more:
            return {s: most * sizes[s] if s in capped else weights[s] * rate for s in sizes}
        capped |= more


def test_mix(docs, spark):
    rows = mixing.mix(docs, cell_rows=16).collect()
    size = lambda t: len(WORD.findall(t or ""))
    assert counted((r.doc_id, r.size) for r in rows) == counted((r[0], size(r[1])) for r in ROWS)
    sizes = collections.Counter()
    for _, t, _, source, _ in ROWS:
        sizes[source] += size(t)
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want = water_fill(sizes, weights, 3)
    assert max(r.copies for r in rows) <= 3 and all(r.copies == 0 for r in rows if r.size == 0)
    taken, found = collections.Counter(), {}
    source_of = {(r[0], r[1]): r[3] for r in ROWS}
    for (i, t), source in source_of.items():
        found[(i, size(t))] = source
    for r in rows:
        if r.size:
            source = found[(r.doc_id, r.size)]
            assert r.target == pytest.approx(want[source], rel=1e-12) and r.source_size == sizes[source]
            taken[source] += r.copies * r.size
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(size(r[1]) for r in ROWS if r[3] == s)
    again = mixing.mix(frame(spark, ROWS, parts=2), cell_rows=16).collect()
    key = lambda r: (r.doc_id, r.size, r.copies)
    assert counted(map(key, again)) == counted(map(key, rows))
    mixed = mixing.mixed_documents(docs, cell_rows=16)
    assert mixed.columns == docs.columns
    assert counted(r.doc_id for r in mixed.collect()) == sum((collections.Counter({r.doc_id: r.copies}) for r in rows), collections.Counter())


def test_pivot_keeps_words_and_expectations():
    rng = np.random.default_rng(1)
    sizes, parts = rng.integers(1, 60, 40).astype(float), rng.uniform(0.05, 0.95, 40)
    mean = np.zeros(40)
    for k in range(3000):
        out = mixing.pivot(sizes, parts, rng.random(40))
        assert ((out > 0) & (out < 1)).sum() <= 1 and math.isclose(out @ sizes, parts @ sizes, rel_tol=1e-6)
        mean += out
    assert np.abs(mean / 3000 - parts).max() < 0.06


# ---- archives -----------------------------------------------------------------------------------


def test_archives(spark, folder):
    html = ["<p>a</p>", "<p>bé</p>", None, "", "x\r\n\r\nWARC/1.1\r\n\r\n", "y" * 3_000_000]
    pages = [(i, f"http://h/{i}\r\nX: y", html[i % 6]) for i in range(30)] + [(3, "u", "<p>a</p>"), (None, None, "<p>a</p>"), (None, "v", "z")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("record_type", F.lit("junk"))
    path = scratch_path(spark, "warc-test")
    warc.write_pages(table.repartition(3), path)
    rows = warc.read_warc(spark, path).collect()
    assert len(rows) == len(pages)
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    import base64

    def digest(h):
        return base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()

    want = collections.Counter()
    for i, _, h in pages:
        f = first.get(h or "")
        again = f is not None and i != f
        want[f"urn:page:{'none' if i is None else i}", "revisit" if again else "response", digest(h), len((h or "").encode()), f"urn:page:{f}" if again else None] += 1
    assert counted((r.record_id, r.record_type, r.payload_digest, r.payload_bytes, r.refers_to) for r in rows) == want
    for r in rows:
        assert (r.payload is None) == (r.record_type == "revisit")
        if r.payload is not None:
            assert digest(bytes(r.payload).decode()) == r.payload_digest
    lean = warc.read_warc(spark, path, payload=False).filter(F.col("record_type") == "revisit")
    assert "PushedFilters" not in str(lean.count()) and lean.count() == sum(n for k, n in want.items() if k[1] == "revisit")
    some = warc.read_warc(spark, path).filter(F.col("record_id").isin("urn:page:1", "urn:page:4")).collect()
    assert {r.record_id for r in some} == {"urn:page:1", "urn:page:4"}
    empty = scratch_path(spark, "warc-none")
    warc.write_pages(table.limit(0), empty)
    assert warc.read_warc(spark, empty).count() == 0


# ---- nearest neighbours -------------------------------------------------------------------------


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(700, 16)).astype(np.float32)
    x[100:160] = x[5]  # equal vectors: ties
    rows = [(i, [float(v) for v in x[i]]) for i in range(700)]
    bad = [(1000, None), (1020, [0.0] * 16), (1040, [math.nan] * 16), (1060, [None] + [1.0] * 15), (1080, [math.inf] * 16), (1100, [1.0])]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))
    found = collections.defaultdict(list)
    for r in ann.search(table.repartition(4), k=10, s=ann.Settings(likely=4.0, block_members=64, block_queries=8)).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(found) == {i for i in range(700) if i % 20 == 0}
    y, hits = x.astype(np.float64), 0
    for q, got in found.items():
        got.sort()
        assert [g[0] for g in got] == list(range(1, 11)) and q not in [g[1] for g in got]
        for _, v, s in got:
            assert s == pytest.approx(float(y[q] @ y[v]), rel=1e-12)
        assert [(g[1]) for g in got] == [g[1] for g in sorted(got, key=lambda g: (-g[2], g[1]))]
        score = y @ y[q]
        score[q] = -np.inf
        hits += len({g[1] for g in got} & set(np.lexsort((np.arange(700), -score))[:10].tolist()))
    assert hits / (10 * len(found)) >= 0.9


def test_few_vectors_are_all_found(spark):
    table = spark.createDataFrame([(i, [float(i + 1), float(-i)]) for i in range(9)], "vec_id long, embedding array<double>")
    assert ann.search(table, every=1).count() == 72
    assert ann.search(table.limit(0)).count() == 0


def test_one_longer_vector_leaves_the_others_in(spark):
    rows = [(i, [float(i + 1), float(-i)]) for i in range(9)] + [(20, [1.0, 2.0, 3.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann.search(table, every=1).collect()
    assert len(found) == 72 and {r.query_id for r in found} == set(range(9))


# ---- classifiers --------------------------------------------------------------------------------


def labelled_rows(n=400):
    rng = np.random.default_rng(2)
    vocab = ["".join(rng.choice(list("aeionrst"), 6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = list(rng.choice(vocab, rng.integers(5, 90)))
        if bad:
            words[rng.integers(len(words))] = "".join(["zgrbl", str(rng.choice(["ix", "aq", "um", "ok"]))])
        text = " ".join(f"{w}###" if bad and k % 2 else w for k, w in enumerate(words))
        rows.append((i, text, None, None, None))
        labels.append((i, int(not bad), int(bad)))
    return rows, labels


@pytest.mark.parametrize("build,label", [(toxicity.toxicity, 2), (quality_model.quality, 1)])
def test_classifiers_hold_on_rows_they_have_not_seen(spark, build, label):
    rows, labels = labelled_rows(1200)
    odd = [(9001, None, None, None, None), (9002, "", None, None, None), (None, "no id", None, None, None), (9003, "w " * 40_000, None, None, None)]
    docs = frame(spark, rows + odd + rows[:3], extra=True)
    table = spark.createDataFrame(labels + [(None, 1, 1), (5, None, None), (7, 3, 3)], "doc_id long, quality int, toxic int")
    got = build(docs, table).collect()
    assert counted(r.doc_id for r in got) == counted(r[0] for r in rows + odd + rows[:3])
    truth, right = {r[0]: r[label] for r in labels}, []
    for r in got:
        assert 0.0 <= r.score <= 1.0
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
        if r.held_out and r.doc_id in truth:
            right.append(r.predicted == truth[r.doc_id])
    assert np.mean(right) >= 0.95
    again = build(docs.repartition(2), table).collect()
    assert counted((r.doc_id, r.score) for r in again) == counted((r.doc_id, r.score) for r in got)
    assert build(docs.limit(0), table).count() == 0
    assert build(docs, table.limit(0)).count() == len(got)


def test_unseen_spellings_share_subwords(spark):
    rows, labels = labelled_rows(800)
    sample_labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    fresh = [(5001, "aaron zgrblev senion", None, None, None), (5002, "aaron senion tarson", None, None, None)]
    got = {r.doc_id: r.score for r in toxicity.toxicity(frame(spark, rows + fresh), sample_labels).collect()}
    assert got[5001] > 0.5 > got[5002]


# ---- secrets ------------------------------------------------------------------------------------

ASSIGN = re.compile(r"""(?a:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(t):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[1]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if m.end() - m.start() >= 32]
    return sorted(out)


def secret_texts(n=250):
    import random

    rnd = random.Random(3)
    parts = ["password", "Token", " ", "=", ":", '"', "'", "AKIA", "ABCD1234EFGH5678", "deadbeef" * 5, "abc", "é\U0001f600", "secret= abcdefgh12", "api_key:", "xYz09+/_.=-Qq", "\n", "Zx8Kq0PlM3vT7wBnR5yH2cJdF6gS"]
    made = ["".join(rnd.choices(parts, k=rnd.randrange(0, 14))) for _ in range(n)]
    return made + [None, "", "token: secret: abcdefgh12", "token=secret=abcdefgh12", ("word " * 20_000) + "password=abcdefgh1", "AKIA" * 5000]


@pytest.fixture(scope="module")
def secret_docs(spark):
    texts = secret_texts()
    return frame(spark, [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], extra=True), texts


def test_secret_spans(secret_docs):
    docs, texts = secret_docs
    found, names = secrets.scan(docs)
    base = F.concat(*[F.col(n) for n in names[:3]])
    rows = found.select("doc_id", secrets.listed(base).alias("base"), secrets.listed(F.concat(base, F.col(names[3]))).alias("all")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = [f"{k}:{a}:{b}" for a, _, b, k in base_spans(texts[r.doc_id] or "")]
        assert r.base == ",".join(want)
        assert [s for s in r["all"].split(",") if s and not s.startswith("random")] == want
    assert any("random" in r["all"] for r in rows)


def test_markov_models_tell_keys_from_names(spark, docs):
    model = secrets.train(secrets.default_samples(docs))
    keys = ["ghp_16C7e42F292c6912E7710c838347Ae178B4a", "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY"]
    names = ["http-server-connection-timeout-seconds", "getUserAccountSettingsFromDatabase", "MAX_CONNECTION_RETRY_COUNT"]
    rows = spark.createDataFrame([(x,) for x in keys + names], "v string").select("v", secrets.ratio(F.col("v"), model).alias("r"))
    got = {r.v: r.r for r in rows.collect()}
    assert min(got[k] for k in keys) > 14 > max(got[k] for k in names)


def test_keys_are_found_behind_names_and_beside_base_spans(spark, docs):
    import random

    rnd = random.Random(8)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    key = lambda n: "".join(rnd.choices(letters, k=n))
    digest = hashlib.md5(b"x").hexdigest()
    before = ["", "client_key_value=", "production_database_encryption_key=", "/home/user/settings/service/remote/config/", f"files/{digest}/"]
    rows = [(b, key(32)) for b in before for _ in range(40)]
    two = (key(40), key(40))
    rows += [("AWS_SECRET_ACCESS_KEY=", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"), ("/first/key=", f"{two[0]}/second/key={two[1]}")]
    plain = ["/home/user/settings/service/remote/config/default/database", "production_database_encryption_key=default_connection_timeout"]
    texts = [f"see {b}{k} end" for b, k in rows] + plain
    table = frame(spark, [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)])
    found, names = secrets.with_spans(table, secrets.train(secrets.default_samples(docs)))
    got = {r.doc_id: r.spans for r in found.select("doc_id", F.col(names[3]).alias("spans")).collect()}
    hits = collections.Counter()
    for i, (b, k) in enumerate(rows[:-1]):
        start = 4 + len(b)
        hits[b] += any(x.start <= start and start + len(k) <= x.stop for x in got[i])
        assert b != before[3] or all(x.start >= start - 12 for x in got[i])
    assert all(hits[b] >= 39 for b in before) and hits["AWS_SECRET_ACCESS_KEY="] == 1, hits
    assert [texts[201][x.start : x.stop] for x in got[201]] == list(two)
    assert not got[202] and not got[203]


def test_redaction_leaves_no_base_secret(secret_docs):
    docs, texts = secret_docs
    clean = secrets.redacted(docs)
    assert clean.columns == docs.columns
    for r in clean.collect():
        before = texts[r.doc_id]
        if before is None:
            assert r.text is None
        elif not base_spans(before) and r.text == before:
            assert r.n_chars == len(before)
        else:
            spans, out, at = base_spans(before), r.text, len(r.text)
            assert r.n_chars == at
            for a, _, b, _ in spans:
                assert before[a:b] not in out or before.count(before[a:b]) > len(spans)


# ---- quality rules ------------------------------------------------------------------------------


def statistics(t):
    t = t or ""
    w = WORD.findall(t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often, again = collections.Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            again.update((i, i + 1, i + 2))
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again)


def rule_rows():
    import random

    rnd = random.Random(9)
    vocab = [f"{a}{b}{c}" for a in "bdglmn" for b in "aeiou" for c in ("st", "ran", "lo", "")]
    rows = []
    for i in range(700):
        words = rnd.choices(vocab, k=rnd.randrange(60, 300))
        if i % 50 == 0:
            words = [w + "###" for w in words]
        rows.append((i, " ".join(words), "en", "s1" if i < 500 else f"t{i % 9}", None))
    odd = ["", None, "one\ntwo words\none\n\none", "a b c a b c a b c", "x " * 60 + "y", "é\U0001f600 # 中文"]
    return rows + [(1000 + i, t, None, None, None) for i, t in enumerate(odd)] + rows[:2]


def test_quality_rules(spark):
    rows = rule_rows()
    found, names = quality_rules.judged(frame(spark, rows, extra=True))
    got = found.collect()
    text = {r[0]: r[1] for r in rows}
    assert counted(r.doc_id for r in got) == counted(r[0] for r in rows)
    for r in got:
        want = statistics(text[r.doc_id])
        assert tuple(r[n] for n in names[:5]) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r[names[5]] == failed
        expected = not failed and not (r.doc_id < 700 and r.doc_id % 50 == 0)
        assert r[names[6]] == expected, r
    docs = frame(spark, rows, extra=True)
    kept = quality_rules.kept_documents(docs)
    assert kept.columns == docs.columns
    assert counted(r.doc_id for r in kept.collect()) == counted(r.doc_id for r in got if r[names[6]])


def test_small_groups_are_judged_by_their_own_language(spark):
    import random

    rnd = random.Random(4)
    vocab = [f"{a}{b}{c}" for a in "bdglmn" for b in "aeiou" for c in ("st", "ran", "lo", "")]
    text = lambda times: " ".join(w * times for w in rnd.choices(vocab, k=rnd.randrange(60, 300)))
    rows = [(i, text(1), "en", f"s{i % 5}", None) for i in range(500)]
    rows += [(1000 + i, text(3), "th", "s1", None) for i in range(150)]  # one source, long words
    rows += [(2000 + i, text(3), "lo", f"s{i % 6}", None) for i in range(120)]  # six sources of twenty
    rows += [(3000 + i, text(1) if i < 100 else text(3), "de", "s1" if i < 100 else "s2", None) for i in range(130)]
    rows += [(4000 + i, text(3), "km", "s1", None) for i in range(3)]
    odd = [(5000 + i, text(3) + " ###" * 200, lang, "s1", None) for i, lang in enumerate(("th", "lo", "de"))]
    found, names = quality_rules.judged(frame(spark, rows + odd))
    got = {r.doc_id: r[names[6]] for r in found.collect()}
    assert [i for i in got if i < 5000 and not got[i]] == []
    assert not any(got[r[0]] for r in odd)


def test_minimum_covariance_against_numpy(spark):
    rng = np.random.default_rng(5)
    a = np.array([[1, 0.5, 0, 0], [0, 1, 0.3, 0], [0, 0, 1, 0.2], [0, 0, 0, 1]])
    x = rng.normal(size=(3000, 4)) @ a
    x[:300] += 25
    table = spark.createDataFrame([("g", *map(float, v)) for v in x], "g string, x0 double, x1 double, x2 double, x3 double")
    row = quality_rules.minimum_covariance(table, "g").first()
    inverse = np.array([[row[f"i{min(i, j)}{max(i, j)}"] for j in range(4)] for i in range(4)])
    good = x[300:]
    assert np.abs(np.array([row[f"m{i}"] for i in range(4)]) - good.mean(axis=0)).max() < 0.15
    assert np.abs(np.linalg.inv(inverse) - np.cov(good.T)).max() < 0.35
    off = x - [row[f"m{i}"] for i in range(4)]
    far = np.einsum("ni,ij,nj->n", off, inverse, off)
    assert far[:300].min() > 50 > np.quantile(far[300:], 0.999)


# ---- joins and components -----------------------------------------------------------------------

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def brute_groups(rows):
    sets = []
    for _, t, *_ in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(LOWER))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    holders = collections.defaultdict(list)
    for d, s in enumerate(sets):
        for g in s:
            holders[g].append(d)
    common = collections.Counter(p for v in holders.values() for p in itertools.combinations(v, 2))
    parent = list(range(len(rows)))

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for (a, b), c in common.items():
        if 100 * c >= 80 * (len(sets[a]) + len(sets[b]) - c):
            parent[find(a)] = find(b)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[find(k)] = min(least.get(find(k), r[0]), r[0])
    return counted((r[0], len(sets[k]), least.get(find(k)) if sets[k] else r[0]) for k, r in enumerate(rows))


@pytest.mark.parametrize(
    "seed,settings",
    [
        (1, jaccard.Settings()),
        (2, jaccard.Settings(frequent=1, block=8)),
        (3, jaccard.Settings(frequent=1, most_frequent=50, block=8)),
        (4, jaccard.Settings(frequent=1 << 30)),
    ],
)
def test_near_groups_equal_brute_force(spark, seed, settings):
    rows = documents(seed)
    got = jaccard.near_groups(frame(spark, rows, extra=True), settings).collect()
    assert counted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(rows)


def test_one_of_each(spark, docs, none):
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    want = {(i, n, c) for i, n, c in brute_groups(ROWS) if i == c or n == 0}
    assert counted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == counted(i for i, _, _ in want if i is not None)
    assert jaccard.one_of_each(none).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (2000, 2000)] + [(5000, 5000 + i) for i in range(400)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000, **{5000 + i: 5000 for i in range(400)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- encoding -----------------------------------------------------------------------------------


def test_encoding_equals_the_library(spark, docs):
    import random

    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(bpe.default_path()), bpe.Tokenizer(bpe.default_path())
    rnd = random.Random(1)
    alphabet = list("abcdefgh ABC'0123.,!#\n\t\x1c\x85 éßÜĲﬁ½²Ⅷ漢か한İıΣς̧́\U0001f600<|>_-") + ["<|endoftext|>", "<|startoftext|>", "the ", "'re", "'LL", "ing", "a" * 70]
    for _ in range(3000):
        text = "".join(rnd.choices(alphabet, k=rnd.randrange(0, 40)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(own.encode(text)) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)
    text_of = {}
    for r in ROWS:
        text_of.setdefault(r[0], []).append(r[1] or "")
    want = collections.Counter()
    for i, texts in text_of.items():
        for t in texts:
            ids = library.encode(t, add_special_tokens=False).ids
            decoded = library.decode(ids, skip_special_tokens=False)
            want[i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()] += 1
    assert counted(map(tuple, bpe.digests(docs).collect())) == want
    back = bpe.decode(bpe.encode(docs)).collect()
    assert counted((r.doc_id, hashlib.sha256(r.decoded.encode()).hexdigest()) for r in back) == sum(
        (collections.Counter({(k[0], k[3]): n}) for k, n in want.items()), collections.Counter()
    )


def test_cuts_never_split_a_token():
    own = bpe.Tokenizer(bpe.default_path())
    for token in list(own.vocab)[:20_000]:
        if token.endswith(bpe.WORD_END) and token != bpe.WORD_END:
            assert own.cut(token.removesuffix(bpe.WORD_END)) == [token]


# ---- empty tables -------------------------------------------------------------------------------


def test_empty_tables(none):
    assert sharding.shard_documents(none).count() == 0
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    assert quality_rules.judged(none)[0].count() == 0 and quality_rules.kept_documents(none).count() == 0
    assert secrets.redacted(none).count() == 0
    assert bpe.digests(none).count() == 0
