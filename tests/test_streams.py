"""Streams over several micro-batches against the batch operators."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.operators.sequence import monotone_filter
from corpusprep.streaming.state import KeyedState
from corpusprep.streaming.streams import once_per_task, stream_cache_misses, stream_monotone_filter

SCHEMA = "doc long, pos long, page int"


def source(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def test_monotone_stream_over_batches(spark, tmp_path):
    rng = random.Random(1)
    rows = [(d, p, rng.randrange(60) if rng.random() < 0.5 else None) for p in range(90) for d in range(3)]
    path = str(tmp_path / "in")
    for part in range(3):
        df = spark.createDataFrame(rows[part * 90:(part + 1) * 90], SCHEMA).coalesce(1)
        df.write.mode("append").parquet(path)
        got = stream_monotone_filter(source(spark, path), str(tmp_path / "job"), ["doc"])
        want = monotone_filter(spark.createDataFrame(rows[:(part + 1) * 90], SCHEMA), ["doc"])
        assert sorted(map(tuple, got.select("doc", "pos").collect())) == sorted(
            map(tuple, want.select("doc", "pos").collect()))

    # Blocks at or before a document's last position are late, and leave no trace.
    late = spark.createDataFrame([(0, 5, 59), (0, 89, 59), (0, 90, None), (7, 0, 1)], SCHEMA)
    late.coalesce(1).write.mode("append").parquet(path)
    got = stream_monotone_filter(source(spark, path), str(tmp_path / "job"), ["doc"])
    judged = spark.read.parquet(str(tmp_path / "job/judged")).filter("batch = 3")
    assert {(r["doc"], r["pos"]): r["status"] for r in judged.collect() if r["status"] == "late"} == {
        (0, 5): "late", (0, 89): "late"}
    assert got.filter("doc = 7").count() == 1


def test_state_of_many_batches(spark, tmp_path):
    """Batches with few keys of many: each writes its own keys' state only, and a replay changes nothing."""
    rng = random.Random(4)
    path, job = str(tmp_path / "in"), str(tmp_path / "job")
    rows = []
    for part in range(9):
        some = rng.sample(range(60), 5) + [0]
        new = [(d, part * 50 + i, rng.randrange(80) if rng.random() < 0.6 else None) for d in set(some) for i in range(20)]
        rows += new
        spark.createDataFrame(new, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        got = stream_monotone_filter(source(spark, path), job, ["doc"])
        written = spark.read.parquet(f"{job}/state/level=0/last={part}")
        assert sorted(r["doc"] for r in written.collect()) == sorted(set(some))
    want = monotone_filter(spark.createDataFrame(rows, SCHEMA), ["doc"])
    right = sorted(map(tuple, want.select("doc", "pos").collect()))
    assert sorted(map(tuple, got.select("doc", "pos").collect())) == right
    # Merged segments are gone, and the log says which are left.
    left = sorted(p.name for p in (tmp_path / "job/state").glob("level=*/last=*"))
    assert left == ["last=3", "last=7", "last=8"]

    # The last batch did not commit: it runs again over the same state.
    commit = tmp_path / "job/checkpoint/commits/8"
    for name in (commit, commit.with_name(".8.crc")):
        name.unlink(missing_ok=True)
    again = stream_monotone_filter(source(spark, path), job, ["doc"])
    assert sorted(map(tuple, again.select("doc", "pos").collect())) == right


@pytest.mark.parametrize("fan", [2, 3, 4])
def test_segments_hold_every_batch_once(fan):
    state = KeyedState("x", T.StructType(), [], fan=fan)
    for number in range(200):
        upto = 0
        for level, last in state.segments(number):
            assert last == upto + fan**level - 1
            upto = last + 1
        assert upto == number
        assert len(state.segments(number)) <= (fan - 1) * 8


def test_untouched_buckets_are_not_read(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    state = KeyedState(str(tmp_path / "state"), schema, ["k"], buckets=16, fan=2)
    known = {}
    for number in range(5):
        batch = spark.createDataFrame([(k, f"{k} at {number}") for k in range(number, 40, number + 2)], schema)
        old = {r["k"]: r["v"] for r in state.before(batch, number).collect()}
        keys = {r["k"] for r in batch.collect()}
        assert old == {k: v for k, v in known.items() if k in keys}
        state.write(batch, number)
        known |= {r["k"]: r["v"] for r in batch.collect()}
    one = spark.createDataFrame([(7, "")], schema)
    before = state.before(one, 5)
    assert [r["v"] for r in before.collect()] == [known[7]]
    plan = before._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(", "") and str(one.select(state.bucket()).first()[0]) in plan


def test_misses_come_once(spark, tmp_path):
    schema = "ts timestamp, text string"
    path = str(tmp_path / "in")
    for part in range(2):
        rows = spark.range(40).select(
            F.timestamp_seconds(F.col("id") * 7200 + part * 1000).alias("ts"),
            (F.col("id") % (7 + part)).cast("string").alias("text"))
        rows.coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
        got = stream_cache_misses(stream, str(tmp_path / "job"), "text")
        assert sorted(r["text"] for r in got.collect()) == [str(i) for i in range(7 + part)]


def test_late_texts_are_reported(spark, tmp_path):
    schema = "ts timestamp, text string"
    path = str(tmp_path / "in")
    for day, text in ((20, "a"), (1, "b"), (2, None), (3, "a"), (1, None)):
        row = spark.sql("SELECT 1 AS one").select(
            F.expr(f"timestamp'2024-01-{day:02d}'").alias("ts"), F.lit(text).cast("string").alias("text"))
        row.coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = stream_cache_misses(stream, str(tmp_path / "job"), "text").collect()
    assert sorted(str(r["text"]) for r in got) == ["None", "a", "b"]


def test_hot_text_is_thinned_before_the_shuffle(spark, tmp_path):
    rows = spark.range(50_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).cast("string").alias("text"))
    thin = once_per_task(rows.repartition(4), "text")
    assert thin.count() <= 5_000 + 4
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("text string").parquet(str(tmp_path / "in"))
    assert stream_cache_misses(stream, str(tmp_path / "job"), "text").count() == 5_001
    state = [p.name for p in (tmp_path / "job/checkpoint/state/0/0").iterdir()]
    assert any(n.endswith((".changelog", ".zip")) for n in state)


def test_event_stream_reads_files_and_folders(spark, tmp_path):
    from corpusprep.catalog.streams import event_stream

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "many" / "events.parquet"))
    for folder in ("/root/testdata/sf0.001", str(tmp_path / "many")):
        got = stream_cache_misses(event_stream(spark, folder), str(tmp_path / folder.replace("/", "_")), "props")
        assert got.count() == events.select("props").distinct().count()
