"""Window forms against plain loops over the blocks, on random documents."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.operators import packing, sequence as sq
from corpusprep.operators.concat import concat_ordered
from corpusprep.operators.scan import looking_ahead

BITS = [0, 2, 3]


def random_blocks(seed, docs=6, size=60):
    rng = random.Random(seed)
    rows = []
    for doc in range(docs):
        page, gap = 0, 1 + doc % 3
        for i in range(rng.randrange(1, size)):
            page = max(0, page + rng.randrange(-15, 20))
            marked = rng.random() < 0.4
            rows.append((doc, i * gap, f"b{doc}.{i}", [page] if marked else [], page if marked else None,
                         rng.choice("hcdsep")))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc long, pos long, text string, pages array<int>, page int, kind string")


def by_doc(rows):
    out = {}
    for r in sorted(rows):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("bits", BITS)
@pytest.mark.parametrize("seed", [1, 2])
def test_monotone_filter(spark, bits, seed):
    rows = random_blocks(seed)
    want = set()
    for doc, blocks in by_doc(rows).items():
        top, muted = -1, False
        for _, pos, _, _, page, _ in blocks:
            if page is not None:
                muted = top >= 0 and page < top - 10
                top = top if muted else max(top, page)
            if not muted:
                want.add((doc, pos))
    got = sq.monotone_filter(frame(spark, rows), ["doc"], bits=bits).select("doc", "pos")
    assert {tuple(r) for r in got.collect()} == want


@pytest.mark.parametrize("bits", BITS)
def test_window_filter(spark, bits):
    rows = random_blocks(3)
    want = set()
    for doc, blocks in by_doc(rows).items():
        seen, open_ = False, True
        for _, pos, _, pages, _, _ in blocks:
            if any(22 <= p <= 48 for p in pages):
                seen = open_ = keep = True
            elif pages:
                keep, open_ = False, open_ and not seen
            else:
                keep = open_ or not seen
            if keep:
                want.add((doc, pos))
    got = sq.window_filter(
        frame(spark, rows), ["doc"], F.lit(30), F.lit(40), bits=bits).select("doc", "pos")
    assert {tuple(r) for r in got.collect()} == want


@pytest.mark.parametrize("bits", BITS)
def test_fence_state(spark, bits):
    rows = random_blocks(4)
    want = set()
    for doc, blocks in by_doc(rows).items():
        code = display = 0
        for _, pos, _, _, _, kind in blocks:
            want.add((doc, pos, code, display))
            if kind == "c":
                code = 1 - code
            elif kind == "d":
                display = 1 - display
            elif kind == "s":
                display = 1
            elif kind == "e":
                display = 0
    k = F.col("kind")
    got = sq.fence_state(frame(spark, rows), ["doc"], k == "c", k == "d", k == "s", k == "e", bits=bits)
    assert {tuple(r) for r in got.select("doc", "pos", "in_code", "in_display").collect()} == want


@pytest.mark.parametrize("bits", BITS)
def test_merge_and_remove_ranges(spark, bits):
    rng = random.Random(5)
    ranges = [(d, s, s + rng.randrange(0, 12), rng.choice("xyz")) for d in range(5)
              for s in (rng.randrange(0, 150) for _ in range(15))]
    blocks = [(d, p) for d in range(6) for p in range(0, 160, 2)]
    merged, removed = set(), set()
    for d in range(5):
        out = []
        for _, s, e, _ in sorted(r for r in ranges if r[0] == d):
            if out and s <= out[-1][1]:
                out[-1][1] = max(out[-1][1], e)
                out[-1][2] += 1
            else:
                out.append([s, e, 1])
        merged |= {(d, *o) for o in out}
        removed |= {(d, p) for _, p in (b for b in blocks if b[0] == d) if any(s <= p < e for s, e, _ in out)}
    df = spark.createDataFrame(ranges, "doc long, s long, e long, label string")
    got = sq.merge_ranges(df, ["doc"], bits)
    assert {tuple(r) for r in got.select("doc", "s", "e", "n_ranges").collect()} == merged
    assert got.select(F.sum(F.aggregate("labels", F.lit(0).cast("long"), lambda a, x: a + x["n"]))).first()[0] == 75
    left = sq.remove_ranges(spark.createDataFrame(blocks, "doc long, pos long"), df, ["doc"], bits=bits)
    assert {tuple(r) for r in left.collect()} == set(blocks) - removed


def test_merged_shares_are_bounded(spark, monkeypatch):
    """The number of partitions follows the size of the ranges; before, it was fixed and merged again."""
    monkeypatch.setattr(sq, "PART_ROWS", 100)
    rows = lambda n: spark.createDataFrame([(i % 40, 7 * i, 7 * i + i % 9, "ab"[i % 2]) for i in range(n)], "doc long, s long, e long, label string")
    few, many = (sq.merge_ranges(rows(n), ["doc"], 0) for n in (50, 4000))
    assert many.rdd.getNumPartitions() == 41 and few.rdd.getNumPartitions() <= 4
    assert many.agg(F.sum("n_ranges")).first()[0] == 4000


@pytest.mark.parametrize("bits", BITS)
def test_pack_batches(spark, bits):
    rng = random.Random(6)
    rows = [(d, p, rng.choice([1, 5, 20, 90])) for d in range(5) for p in range(rng.randrange(1, 80))]
    want = set()
    for d in range(5):
        fill = batch = 0
        for _, p, n in (r for r in rows if r[0] == d):
            if fill and fill + n + 2 > 60:
                fill, batch = 0, batch + 1
            fill += n + 2
            want.add((d, p, batch))
    df = spark.createDataFrame(rows, "doc long, pos long, n int")
    got = packing.pack_batches(df, ["doc"], F.col("n"), limit=60, overhead=2, bits=bits)
    assert {tuple(r) for r in got.collect()} == want


def test_transfer_tables_agree_with_the_fold():
    rng = np.random.default_rng(7)
    for _ in range(60):
        w = rng.integers(1, 40, rng.integers(1, 30))
        table = packing._pack_transfer(50)(w)
        for state in range(0, 70):
            fill, n = state, 0
            for size in w.tolist():
                if fill and fill + size > 50:
                    fill, n = 0, n + 1
                fill += size
            rows = [r for r in table if r[0] <= state <= r[1]]
            assert len(rows) == 1
            _, _, base, slope, emitted = rows[0]
            assert (base + slope * state, emitted) == (fill, n)


@pytest.mark.parametrize("bits", [0, 2, 5])
def test_split_in_order(spark, bits):
    rng = random.Random(8)
    rows = []
    for doc in range(6):
        page = 0
        for i in range(rng.randrange(1, 90)):
            page = max(0, page + rng.randrange(-4, 6))
            rows.append((doc, 3 * i, page if rng.random() < 0.4 else None, rng.choice("hbttt")))
    want = set()
    for doc, lines in by_doc(rows).items():
        start, bound, first_page, top, n = 0, 10, 0, 0, len(lines)
        for i, (_, _, page, _) in enumerate(lines):
            if page is None:
                continue
            top = max(top, page)
            if page < bound:
                continue
            low, cut = max(start + 1, i - 12), None
            for j in range(i, low - 1, -1):
                if lines[j][3] == "h" and j > start + 3:
                    cut = j
                    break
            if cut is None:
                cut = next((j + 1 for j in range(i, low - 1, -1) if lines[j][3] == "b" and j + 1 > start + 3), i)
            if cut > start:
                want.add((doc, first_page, bound - 1, start, cut - start))
            start, first_page, bound = cut, bound, bound + 10
        if start < n:
            want.add((doc, first_page, top if top >= first_page else first_page + 9, start, n - start))
    df = spark.createDataFrame(rows, "doc long, pos long, page int, kind string")
    got = packing.split_in_order(df, ["doc"], F.col("kind") == "h", F.col("kind") == "b", width=10,
                                 back=12, bits=bits)
    assert {tuple(r) for r in got.collect()} == want


@pytest.mark.parametrize("bits", BITS)
def test_concat_ordered_keeps_the_whole_text(spark, bits):
    rows = random_blocks(9)
    parts = concat_ordered(frame(spark, rows), ["doc"], "pos", sep="|", part_chars=40, bits=bits).collect()
    for doc, blocks in by_doc(rows).items():
        mine = sorted((r["part"], r["text"]) for r in parts if r["doc"] == doc)
        assert "|".join(t for _, t in mine) == "|".join(b[2] for b in blocks)
        assert [p for p, _ in mine] == sorted({p for p, _ in mine})
    assert max(len(r["text"]) for r in parts) < 50


@pytest.mark.parametrize("bits", [0, 3])
def test_looking_ahead(spark, bits):
    rows = random_blocks(10)
    got = looking_ahead(frame(spark, rows), ["doc"], "pos", F.col("text"), 4, "nx", bits)
    ahead = {(r["doc"], r["pos"]): r["nx"] for r in got.collect()}
    for doc, blocks in by_doc(rows).items():
        texts = [b[2] for b in blocks]
        for i, b in enumerate(blocks):
            assert ahead[doc, b[1]] == texts[i + 1:i + 5]


@pytest.mark.parametrize("bits", BITS)
def test_edits(spark, bits):
    rows = random_blocks(11)
    k = F.col("kind")
    near = sq.edit_nearest(frame(spark, rows), ["doc"], k == "h", k == "e", F.lit("new"), 30, bits=bits)
    first = sq.edit_section(frame(spark, rows), ["doc"], k == "h", k == "e", F.lit("new"), bits=bits)
    want_near, want_first = set(), set()
    for doc, blocks in by_doc(rows).items():
        def put(out, s, e):
            for b in blocks:
                if s is None or e is None or not s <= b[1] < e:
                    out.add((doc, b[1], b[2]))
                elif b[1] == s:
                    out.add((doc, b[1], "new"))

        e = next((b[1] for b in blocks if b[5] == "e"), None)
        s = None if e is None else max((b[1] for b in blocks if b[5] == "h" and b[1] < e), default=None)
        put(want_near, s if s is not None and e - s <= 30 else None, e)
        s = next((b[1] for b in blocks if b[5] == "h"), None)
        e = None if s is None else next((b[1] for b in blocks if b[5] == "e" and b[1] > s), None)
        put(want_first, s, e)
    assert {tuple(r) for r in near.select("doc", "pos", "text").collect()} == want_near
    assert {tuple(r) for r in first.select("doc", "pos", "text").collect()} == want_first


def test_a_hot_key_is_spread(spark):
    """Two thirds of the rows have one key; no task of the scan may see them all."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id")).alias("doc"), F.col("id").alias("pos"),
        (F.col("id") % 97).cast("int").alias("page"))
    flags = sq.inherit_page(rows, ["doc"], bits=10).withColumn("task", F.spark_partition_id())
    per_task = [r["count"] for r in flags.filter("doc = 0").groupBy("task").count().collect()]
    assert sum(per_task) == 20_000 and max(per_task) < 15_000


@pytest.mark.parametrize("bits", [0, 6, None])
def test_folds_survive_adaptive_joins(spark, monkeypatch, bits):
    """A join before the fold, turned into a broadcast at run time, must not scatter keys."""
    from corpusprep.operators import scan

    monkeypatch.setattr(scan, "WHOLE_BYTES", -1)
    monkeypatch.setattr(scan, "BITS", 9)
    monkeypatch.setattr(scan, "HOT_KEYS", 3)
    base = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("doc"), F.col("id").alias("pos"))
    names = spark.range(40).select(F.col("id").alias("doc"), (F.col("id") % 7 + 1).cast("int").alias("n"))
    rows = base.join(names.groupBy("doc").agg(F.max("n").alias("n")).hint("merge"), "doc")
    got = packing.pack_batches(rows, ["doc"], F.col("n"), limit=50, overhead=1, bits=bits)
    sizes = {r["doc"]: (r["m"], r["n"]) for r in got.groupBy("doc").agg(
        F.max("batch").alias("m"), F.count("*").alias("n")).collect()}
    for doc, (top, n) in sizes.items():
        per_batch = 50 // (doc % 7 + 2)
        assert top == (n - 1) // per_batch
    assert sum(n for _, n in sizes.values()) == 40_000
