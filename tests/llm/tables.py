"""Small tables for the corpus operators."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns that have the names of results.
CLASHING = ", shard int, slot string, score string, spans string, kept string, n int, node string, ids string, label int, list string"


def documents(spark, texts, first=0):
    rows = [(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def clashing(spark, texts):
    rows = [(i, t, "en", "s", 1, 1, "x", "x", "x", "x", 1, "x", "x", 1, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS + CLASHING)


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    known = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(vocabulary)]
    return [rng.choice(known) for _ in range(n)]


ODD_TEXTS = [None, "", " \t\n", "a", "é ü 日本", "same text here", "same text here", "x" * 50_000, "word " * 20_000]
