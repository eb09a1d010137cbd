"""Small documents with all that the operators must bear."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# extra columns whose names operators might want for themselves
CLASHING = ("size", "hash", "cls", "n", "row", "block", "kept", "shard", "slot", "_words", "_n_words", "_kept", "_assign", "mark", "copies", "label", "score")


def documents(seed=1, words=400):
    """Families of near copies, exact copies, chains, shared passages, short, empty, null and long texts."""
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(words)]
    texts = []
    passage = rnd.choices(vocab, k=60)
    for f in range(14):
        base = rnd.choices(vocab, k=rnd.choice([3, 6, 9, 20, 40, 80, 150])) + (passage if f % 3 == 0 else [])
        rate = rnd.choice([0, 0.005, 0.01, 0.03])
        for _ in range(rnd.choice([2, 3, 8, 20])):
            texts.append(" ".join(w if rnd.random() >= rate else rnd.choice(vocab) for w in base))
    texts += [" ".join(rnd.choices(vocab, k=rnd.randrange(1, 150))) for _ in range(60)]
    texts += [" ".join(passage + rnd.choices(vocab, k=rnd.randrange(0, 60))) for _ in range(40)]
    chain = rnd.choices(vocab, k=120)
    for _ in range(25):
        chain[rnd.randrange(120)] = rnd.choice(vocab)
        texts.append(" ".join(chain))
    texts += ["", "  \n\t", None, None, "a b c", "A  b c", "a b", "é\U0001f600 中文 x", "one\ntwo\none\n\none"]
    texts.append(" ".join(rnd.choices(vocab, k=30_000)))
    rnd.shuffle(texts)
    langs, sources = ["en", "de", None], ["s1", "s2", "s3", None, ""]
    rows = [(i + 1, t, rnd.choice(langs), "s1" if i % 3 == 0 else rnd.choice(sources), len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[5], (None, "no id here", "en", "s2", 10), (None, None, None, None, None)]


def frame(spark, rows, extra=False, parts=5):
    from pyspark.sql import functions as F

    out = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return out.select("*", *[F.lit(7).alias(c) for c in CLASHING]) if extra else out
