"""Ranked search against a plain program and, on whole tables, against SQL."""

import math
import re
from collections import Counter

import corpora
import duckdb
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import lexical_search
from corpusprep.llm.queries import ORACLES, QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(ASCII))


def brute(docs, items, top=20):
    held = [(d, Counter(t), len(t)) for d, t in ((d, terms(t)) for d, t in docs) if t]
    n_docs, length = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        rows = []
        for d, c, n in held:
            m = 100 - 25 + 25 * n * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in terms(text) if t in c)
            if score > 0:
                rows.append((d, score))
        rows.sort(key=lambda r: (-r[1], r[0] is None, r[0] or 0))
        out += [(item, i + 1, d, s) for i, (d, s) in enumerate(rows[:top])]
    return sorted(out, key=str)


def held(df):
    return sorted(map(tuple, df.collect()), key=str)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("term", F.lit(1)).withColumn("key", F.lit(2))


ITEMS = [
    (1, "alpha BETA alpha, été"), (2, "straße 日本 it's"), (3, None), (4, " .,;"), (5, "nowhere"), (6, "x X x"),
    (6, "x X x"), (6, "Omega the"), (None, "gamma"), (7, "1 2 3 \U0001f600"), (8, "line endoftext 'tis ababab"),
]


@pytest.mark.parametrize("sizes", [{}, {"part_cells": 3}, {"part_bytes": 40}])
def test_against_plain_program(spark, sizes, monkeypatch):
    docs = corpora.hard(spark).repartition(5)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = held(lexical_search.search(docs, items_of(spark, ITEMS), **sizes))
    assert got == brute(rows, ITEMS)
    assert len(got) > 40


def test_ties_and_small_slices(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "CELLS", 1)
    docs = corpora.table(spark, ["a b", "b a", "a b c"] * 40 + ["c c"]).repartition(6)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(1, "a"), (2, "b c"), (3, "c")]
    assert held(lexical_search.search(docs, items_of(spark, items))) == brute(rows, items)


def test_best_of_many_slices():
    import random

    import numpy as np

    rng = random.Random(2)
    best, rows = lexical_search.Best(3, 4), []
    for at in range(0, 300, 30):
        ids = rng.sample(range(10_000), 30)
        scores = np.array([[rng.randrange(6) for _ in range(3)] for _ in ids], np.int64)
        best.add(scores, ids)
        rows += [(j, -int(s[j]), d) for d, s in zip(ids, scores) for j in range(3) if s[j]]
    want = [r for j in range(3) for r in sorted(r for r in rows if r[0] == j)[:4]]
    assert sorted(zip(best.item.tolist(), (-best.score).tolist(), best.docs)) == want


def test_long_text_in_stretches(spark):
    text = "alpha beta, " * 300_000 + "omega" * 400_000 + " gamma"
    assert lexical_search.terms_of(text.encode()) == [t.encode() for t in terms(text)]
    docs = spark.createDataFrame([(1, text), (2, "gamma alpha")], "doc_id long, text string")
    items = [(1, "gamma"), (2, "beta ALPHA")]
    assert held(lexical_search.search(docs, items_of(spark, items))) == brute([(1, text), (2, "gamma alpha")], items)


def test_empty(spark):
    assert lexical_search.search(corpora.empty(spark), items_of(spark, ITEMS)).collect() == []
    assert lexical_search.search(corpora.hard(spark), items_of(spark, ITEMS).limit(0)).collect() == []
    assert lexical_search.search(corpora.table(spark, [None, "", "."]), items_of(spark, ITEMS)).collect() == []


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    out = QUERIES["op13_lexical_search"](spark, sf)
    assert out.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    want = con.execute(ORACLES["op13_lexical_search"]).fetchall()
    assert held(out) == sorted(map(tuple, want), key=str) and len(want) > 100
