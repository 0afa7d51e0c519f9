"""Fingerprints, bit-sliced comparison and components against plain loops."""

import random

import corpora
import numpy as np
import pytest
import xxhash

from corpusprep.llm import simhash_dedup as sh


def plain(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else \
        [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(keys, links):
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}


def near(rng, fp, flips):
    for b in rng.sample(range(64), flips):
        fp ^= 1 << b
    return fp


def families(seed, n):
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        fp = rng.getrandbits(64)
        out.append(fp)
        for _ in range(rng.choice([0, 0, 1, 5])):
            fp = near(rng, fp, rng.randint(1, 5))
            out.append(fp)
    return sorted(set(out[:n]))


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_near_pairs(radius):
    rng = random.Random(radius)
    fps = np.array(families(radius, 400), np.uint64)
    group = np.sort(np.array([rng.randrange(3) for _ in fps]))
    got = sorted(zip(*map(np.ndarray.tolist, sh.near_pairs(fps, group, np.full(len(fps), 2), radius))))
    want = [(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps))
            if group[i] == group[j] and bin(int(fps[i]) ^ int(fps[j])).count("1") <= radius]
    assert sorted(tuple(sorted(p)) for p in got) == want


def test_near_pairs_across_sides():
    rng = random.Random(9)
    fps = np.array(families(9, 300), np.uint64)
    side = np.array([rng.randrange(2) for _ in fps])
    a, b = sh.near_pairs(fps, np.zeros(len(fps), int), side, 3)
    want = {(i, j) for i in range(len(fps)) for j in range(len(fps))
            if side[i] == 0 and side[j] == 1 and bin(int(fps[i]) ^ int(fps[j])).count("1") <= 3}
    assert set(zip(a.tolist(), b.tolist())) == want


def test_components_of_a_path(spark):
    n = 60
    order = list(range(n))
    random.Random(3).shuffle(order)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in sh.components(edges).collect()}
    assert got == {i: 0 for i in range(1, n)} | {101: 100}
    assert sh.components(edges.limit(0)).collect() == []


@pytest.mark.parametrize("chunk", [2048, 2])
def test_near_duplicates(spark, chunk):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 120))) for _ in range(40)]
    for i in range(120):
        split = texts[rng.randrange(40)].split(" ")
        split[rng.randrange(len(split))] = "changed"
        texts.append(" ".join(split) if i % 3 else texts[rng.randrange(40)])
    texts += [None, "", " \n", "A b C", "a B c"]
    docs = corpora.table(spark, texts)
    got = {r["doc_id"]: (r["fp"] & (1 << 64) - 1, r["component_id"]) for r in sh.near_duplicates(docs, chunk=chunk).collect()}
    fps = {i: plain(t) for i, t in enumerate(texts)}
    links = [(i, j) for i in fps for j in fps if i < j and bin(fps[i] ^ fps[j]).count("1") <= 3]
    want = grouped(fps, links)
    assert got == {i: (fps[i], want[i]) for i in fps}


def test_keep_one_and_hard_rows(spark):
    docs = corpora.hard(spark)
    found = sh.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    kept = sh.keep_one(docs).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({r["component_id"] for r in found})
    assert sh.keep_one(docs).columns == docs.columns
    # Without ids one row per distinct text stays.
    lost = corpora.table(spark, ["p q r s", "p q r s", "unlike the rest of it", None]).selectExpr(
        "CAST(NULL AS long) AS doc_id", "text")
    assert sorted(str(r["text"]) for r in sh.keep_one(lost).collect()) == ["None", "p q r s", "unlike the rest of it"]
    assert sh.keep_one(corpora.empty(spark)).collect() == []
