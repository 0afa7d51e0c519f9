"""The stored cache against a dictionary."""

import random

import pytest
from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.operators.cache_store import SCHEMA, CacheStore, lookup_stored


def files(path):
    return {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_store(spark, tmp_path, monkeypatch):
    rng = random.Random(1)
    store = CacheStore(spark, str(tmp_path / "cache"), buckets=4, fan=3)
    known = {}
    assert store.entries().collect() == []
    for turn in range(8):
        new = {f"k{rng.randrange(60)}": f"{turn}" for _ in range(12)}
        before = files(tmp_path)
        store.upsert(spark.createDataFrame([*new.items(), (None, "x")], SCHEMA))
        # What was stored is left as it is.
        assert all(files(tmp_path).get(p) == t for p, t in before.items())
        known |= new
        assert {r["md5"]: r["translated"] for r in store.entries().collect()} == known
        asked = spark.createDataFrame([(f"k{i}", i) for i in range(80)] + [(None, 80)], "md5 string, i int")
        got = {r["i"]: (r["translated"], r["known"]) for r in store.probe(asked).collect()}
        assert got == {i: (known.get(f"k{i}"), f"k{i}" in known) for i in range(80)} | {80: (None, False)}
    names = {p.name for p in (tmp_path / "cache").iterdir()}
    assert {"base-2", "base-5", "delta-6", "delta-7"} <= names and "base-7" not in names
    # Another reader finds the same; a folder that is not complete does not count.
    (tmp_path / "cache" / "delta-7" / "_SUCCESS").unlink()
    assert CacheStore(spark, str(tmp_path / "cache"), buckets=4, fan=3)._folders() == (5, [6])


def test_the_store_does_not_move(spark, tmp_path, monkeypatch):
    from corpusprep.operators import lookup

    monkeypatch.setattr(lookup, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = CacheStore(spark, str(tmp_path / "cache"), buckets=4, fan=2)
        for part in range(2):
            store.upsert(spark.range(part * 100, part * 100 + 100).select(
                tx.digest(F.col("id").cast("string")).alias("md5"), F.col("id").cast("string").alias("translated")))
        asked = spark.range(150, 300).select(tx.digest(F.col("id").cast("string")).alias("md5"), "id")
        found = store.probe(asked)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        assert found.filter("known").count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("mode", ["foreign", "reference"])
def test_lookup_and_poison(spark, tmp_path, mode):
    store = CacheStore(spark, str(tmp_path / "cache"), buckets=2)
    texts = ["one", "two MATHBLK0000X", "three", None, "one", ""]
    chunks = spark.createDataFrame(list(enumerate(texts)), "pos long, text string")
    assert {r["status"] for r in lookup_stored(chunks, store).collect()} == {"miss"}
    keyed = chunks.select(tx.digest("text").alias("md5"), "text").filter("text IS NOT NULL")
    put = F.when(F.col("text") == "three", "MATHINL0001X").when(F.col("text") != "", F.upper("text"))
    store.upsert(keyed.select("md5", put.alias("translated")).filter("translated IS NOT NULL"))
    got = {r["pos"]: (r["status"], r["translated"]) for r in lookup_stored(chunks, store, mode=mode).collect()}
    two = ("hit", "TWO MATHBLK0000X") if mode == "foreign" else ("poisoned", None)
    assert got == {0: ("hit", "ONE"), 1: two, 2: ("poisoned", None), 3: ("miss", None), 4: ("hit", "ONE"), 5: ("miss", None)}
    assert store.evict_poisoned(("MATHINL",)) == 1
    again = {r["pos"]: r["status"] for r in lookup_stored(chunks, store, mode=mode).collect()}
    assert again[2] == "miss" and again[0] == "hit"
