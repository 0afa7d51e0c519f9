"""Small tables with the cases every operator must bear."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("h", "g", "fp", "d", "d1", "d2", "w", "block", "key", "kept", "runs", "n", "payload", "score", "digest")


def sentence(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def hard_texts(seed=1):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "été", "straße", "日本", "x", "Omega,", "THE"]
    long = sentence(rng, words, 6000)
    base = sentence(rng, words, 60)
    return [
        None, "", " ", "\n\n", "a", "one two", "one  two\t three\r\n", base, base, base + " tail",
        "head " + base, sentence(rng, words, 40), "é" * 300, "ab" * 400, "\x1c\x85 \xa0x", "it's we'll 'tis ''s",
        "line\nline\nline\n\nline", "1 2 3 4 5 " * 30, long, "<|endoftext|> a<|endoftext|>", "\0 \x7f \ufffd", "\U0001f600 x",
    ]


def table(spark, texts, clash=True):
    rows = [(i, t, ["en", "fr", None][i % 3], f"s{i % 2}", None if t is None else len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(7) for c in CLASHING}) if clash else df


def hard(spark):
    """Hard texts, then a row that is repeated, and a row without an id."""
    texts = hard_texts()
    df = table(spark, texts)
    again = df.filter("doc_id = 7")
    lost = df.filter("doc_id = 11").withColumn("doc_id", F.lit(None).cast("long"))
    return df.unionByName(again).unionByName(lost)


def empty(spark):
    return table(spark, ["x"]).limit(0)
