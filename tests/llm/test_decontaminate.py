"""Benchmark items in documents against sliding every window."""

import collections
import random

import corpora
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import decontaminate as dc


def brute(texts, items):
    out = {}
    for i, text in items:
        words = (text or "").encode().lower().split()
        if not words:
            continue
        n, k = len(words), min(5, len(words))
        item = collections.Counter(tuple(words[j:j + k]) for j in range(n - k + 1))
        for d, t in texts:
            w = (t or "").encode().lower().split()
            best = 0
            for s in range(len(w) - n + 1):
                window = collections.Counter(tuple(w[j:j + k]) for j in range(s, s + n - k + 1))
                both = sum((window & item).values())
                best = max(best, both / (2 * (n - k + 1) - both))
            if best >= 0.8:
                out[d, i] = round(best, 9)
    return out


@pytest.fixture(scope="module")
def case():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    make = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(make(n))) for i, n in enumerate([1, 2, 4, 5, 6, 13, 30, 60, 300])]
    items += [(20, None), (21, ""), (22, items[6][1]), (23, "same same same same same same same same")]
    texts = []
    for _ in range(60):
        _, item = items[rng.choice([3, 4, 5, 6, 7, 8])]
        part = item.split(" ")
        if rng.random() < 0.5:
            part[rng.choice([0, -1, len(part) // 2])] = "other"
        if rng.random() < 0.3:
            part = part[1:]
        texts.append(" ".join(make(rng.randint(0, 40)) + part + make(rng.randint(0, 40))).upper())
    texts += [None, "", "same " * 50, items[8][1], items[8][1], "w1", " \n"]
    return list(enumerate(texts)), items


@pytest.mark.parametrize("broadcast_rows", [None, -1])
def test_contaminated(spark, case, broadcast_rows):
    texts, items = case
    docs = corpora.table(spark, [t for _, t in texts])
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("d", F.lit(1))
    got = dc.contaminated(docs, bench, broadcast_rows=broadcast_rows).collect()
    found = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in got}
    assert found == brute(texts, items)
    assert all(r["distance"] <= dc.RADIUS for r in got)
    clean = {r["doc_id"] for r in dc.drop_contaminated(docs, bench).collect()}
    assert clean == {d for d, _ in texts} - {d for d, _ in found}


def test_native_fingerprint(spark):
    rng = random.Random(1)
    rows = [(n, n, [rng.getrandbits(64) - (1 << 63) for _ in range(n)]) for n in (1, 2, 3, 64, 127, 128, 400)]
    contents = spark.createDataFrame(rows, "n_words int, w long, sh array<long>")
    got = dc.fingerprints(contents).join(contents, ["n_words", "w"]).collect()
    assert len(got) == len(rows)
    for r in got:
        bits = np.array([[h >> b & 1 for b in range(64)] for h in r["sh"]]).sum(0)
        want = sum(1 << b for b in range(64) if 2 * bits[b] > len(r["sh"]))
        assert r["fp"] & (1 << 64) - 1 == want


def test_nothing(spark, case):
    texts, items = case
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = corpora.table(spark, [t for _, t in texts])
    assert dc.contaminated(corpora.empty(spark), bench).collect() == []
    assert dc.contaminated(docs, bench.limit(0)).collect() == []
    assert dc.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_hard_rows(spark):
    docs = corpora.hard(spark)
    texts = [(i, r["text"]) for i, r in enumerate(docs.collect())]
    item = " ".join(corpora.hard_texts()[7].split()[10:40])
    bench = spark.createDataFrame([(1, item), (1, item)], "item_id long, text string")
    got = dc.contaminated(docs, bench)
    want = len(brute(texts, [(1, item)]))
    assert got.count() == want


@pytest.mark.parametrize("broadcast_rows", [None, -1])
def test_documents_shorter_than_the_item(spark, broadcast_rows):
    item = [f"w{i}" for i in range(60)]
    texts = [" ".join(t) for t in (item[1:], item[:-1], item[:50], item[:49], item[:48], item[:30], ["x", *item[1:50]])]
    longer = " ".join([*item[:50], *["other"] * 30])
    docs = corpora.table(spark, [*texts, longer])
    # The second item has as many words as the third document.
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item[:50]))], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["start_word"], r["n_words"], round(r["similarity"], 9))
           for r in dc.contaminated(docs, bench, broadcast_rows=broadcast_rows).collect()}
    whole = {(i, 1): (0, n, round((n - 4) / 56, 9)) for i, n in ((0, 59), (1, 59), (2, 50), (3, 49))}
    assert {k: v for k, v in got.items() if k[1] == 1} == whole
    assert got[2, 2] == (0, 50, 1.0) and got[7, 2] == (0, 50, 1.0) and got[4, 2] == (0, 48, round(44 / 46, 9))


def test_windows_of_a_long_text_are_rows(spark):
    # Every start once, from ranges that overlap, and no row that holds a text's windows.
    rows = [(1, 5, 3000, p, [20, 40]) for p in range(0, 2996, 3)] + [(2, 5, 18, 4, [20, 40])]
    matched = spark.createDataFrame(rows, "d long, width int, size int, pos int, lengths array<int>")
    got = dc.window_starts(matched, 0.8)
    assert not [c for c, kind in got.dtypes if kind.startswith("array")]
    want = collections.Counter((1, n, n, s) for n in (20, 40) for s in range(3000 - n + 1)) + collections.Counter([(2, 18, 20, 0)])
    assert collections.Counter((r["d"], r["n_words"], r["item_words"], r["start"]) for r in got.collect()) == want
