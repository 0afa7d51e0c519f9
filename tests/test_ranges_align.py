"""Range joins, labels of merged ranges and alignment of revisions against plain programs."""

import random
from difflib import SequenceMatcher

import pytest

from corpusprep.operators import intervals as iv
from corpusprep.operators.align import align_revisions, compared, longest_rising

RANGES = "doc long, first long, last long, range_no int"


def test_nodes_hold_each_number_once(spark):
    rng = random.Random(1)
    pairs = [(a, a + rng.randrange(300)) for a in (rng.randrange(-500, 500) for _ in range(200))] + [(5, 4), (0, 0), (-1, 2**40)]
    df = spark.createDataFrame(pairs, "first long, last long")
    rows = df.select("first", "last", iv.nodes_of(df["first"], df["last"]).alias("n")).collect()
    for r in rows:
        held = sorted((n["node"] << n["level"], (n["node"] + 1) << n["level"]) for n in r["n"])
        assert len(held) <= 2 * 61
        if r["first"] > r["last"]:
            assert held == []
            continue
        # They follow one another without gap.
        assert held[0][0] == r["first"] and held[-1][1] == r["last"] + 1
        assert all(a[1] == b[0] for a, b in zip(held, held[1:]))


@pytest.mark.parametrize("scale", [False, True])
def test_rows_in_ranges(spark, scale, request):
    if scale:
        request.getfixturevalue("at_scale")
    rng = random.Random(2)
    rows = [(i, rng.randrange(4), rng.choice([None, 7, rng.randrange(-40, 200)])) for i in range(300)]
    ranges = [(rng.randrange(4), a, a + rng.randrange(-2, 90), i) for i, a in enumerate(rng.randrange(-50, 150) for _ in range(60))]
    ranges += ranges[:3]
    left = spark.createDataFrame(rows, "id long, doc long, number int")
    right = spark.createDataFrame(ranges, RANGES)
    found = iv.in_ranges(left, right, "number", ["doc"], ["id"])
    want = sorted((i, no) for i, d, n in rows for e, a, b, no in ranges if n is not None and d == e and a <= n <= b)
    assert sorted(map(tuple, found.select("id", "range_no").collect())) == want and len(want) > 500
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert iv.in_ranges(left, right.filter("first > last"), "number", ["doc"], ["id"]).count() == 0
    # Equal numbers ask once, and ranges of keys that no row has are not cut.
    assert "LeftSemi" in (logical := found._jdf.queryExecution().optimizedPlan().toString()) and "Aggregate" in logical
    ends = {(r["doc"], r["range_no"]) for r in iv.past_end(left, right, "number", ["doc"]).collect()}
    top = {d: max(n for _, e, n in rows if e == d and n is not None) for d in range(4)}
    assert ends == {(d, no) for d, _, b, no in ranges if b > top[d]}


@pytest.mark.parametrize("bits", [0, 3])
def test_labels_of_merged_ranges(spark, bits):
    rng = random.Random(3)
    rows = [(d, s, s + rng.randrange(4), rng.choice("abc")) for d in range(3) for s in (rng.randrange(60) for _ in range(80))]
    got = iv.merged_labels(spark.createDataFrame(rows, "doc long, s long, e long, label string"), ["doc"], 4, bits).collect()
    want = {}
    for d in range(3):
        start, end = None, None
        for s, e, label in sorted({r[1:] for r in rows if r[0] == d}):
            if end is None or s > end:
                start, end = s, e
            end = max(end, e)
            want.setdefault((d, start), []).append((s, e, label, rows.count((d, s, e, label))))
    shown = {}
    for r in sorted(got, key=lambda r: (r["doc"], r["s"], r["part"])):
        assert len(r["ranges"]) <= 4
        shown.setdefault((r["doc"], r["s"]), []).extend(map(tuple, r["ranges"]))
    assert shown == want


def test_longest_rising():
    rng = random.Random(4)
    for _ in range(200):
        values = rng.sample(range(20), rng.randrange(9))
        found = [values[i] for i in longest_rising(values)]
        assert found == sorted(set(found))
        best = max((len(s) for m in range(1 << len(values))
                    for s in [[v for i, v in enumerate(values) if m >> i & 1]] if s == sorted(s)), default=0)
        assert len(found) == best


def blocks(spark, lists):
    rows = [(d, p, t) for d, texts in enumerate(lists) for p, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc long, pos int, text string")


def aligned(spark, old, new, **options):
    got = align_revisions(blocks(spark, old), blocks(spark, new), ["doc"], **options).collect()
    for d, (a, b) in enumerate(zip(old, new)):
        here = [r for r in got if r["doc"] == d]
        # Every block once, and what is the same is the same.
        assert sorted(r["a_pos"] for r in here if r["a_pos"] is not None) == list(range(len(a)))
        assert sorted(r["b_pos"] for r in here if r["b_pos"] is not None) == list(range(len(b)))
        kept = sorted((r["a_pos"], r["b_pos"]) for r in here if r["change"] in ("same", "changed"))
        assert [p[1] for p in kept] == sorted(p[1] for p in kept)
        assert all(a[r["a_pos"]] == b[r["b_pos"]] for r in here if r["change"] == "same")
    return [{c: sum(r["change"] == c and r["doc"] == d for r in got) for c in ("same", "changed", "added", "removed")}
            for d in range(len(old))]


def test_one_insertion_is_one_insertion(spark):
    text = [f"block {i}" for i in range(50)]
    old = [text, text, text, text, ["x"] * 5, [], text]
    new = [["new", *text], [*text[:20], *text[21:]], [*text[:9], "other", *text[10:]], [text[-1], *text[:-1]],
           ["x"] * 4 + ["y", "x"], ["a", None], []]
    got = aligned(spark, old, new)
    assert got[0] == {"same": 50, "changed": 0, "added": 1, "removed": 0}
    assert got[1] == {"same": 49, "changed": 0, "added": 0, "removed": 1}
    assert got[2] == {"same": 49, "changed": 1, "added": 0, "removed": 0}
    # A block that was moved is removed and added; the others stay.
    assert got[3] == {"same": 49, "changed": 0, "added": 1, "removed": 1}
    assert got[4]["same"] == 5 and got[5] == {"same": 0, "changed": 0, "added": 2, "removed": 0}
    assert got[6] == {"same": 0, "changed": 0, "added": 0, "removed": 50}


@pytest.mark.parametrize("options", [{}, {"gap_rows": 3}, {"bits": 3}])
def test_random_revisions(spark, options):
    rng = random.Random(5)
    old, new = [], []
    for _ in range(12):
        a = [f"{rng.randrange(200)}" for _ in range(rng.randrange(40))]
        b = [t for t in a if rng.random() < 0.8]
        for _ in range(rng.randrange(6)):
            b.insert(rng.randrange(len(b) + 1), f"{rng.randrange(200)}")
        old.append(a)
        new.append(b)
    got = aligned(spark, old, new, **options)
    if not options:
        found = sum(g["same"] for g in got)
        plain = sum(sum(m.size for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()) for a, b in zip(old, new))
        assert found >= 0.97 * plain


def test_compared():
    assert compared(list("abc"), list("axc")) == [(0, 0, "same"), (1, 1, "changed"), (2, 2, "same")]
    assert compared([], list("a")) == [(None, 0, "added")] and compared(list("a"), []) == [(0, None, "removed")]


def test_many_cuts_in_linear_time():
    import time

    from corpusprep.operators.packing import cut_starts

    cuts = [{"i": 10 * k, "hs": [10 * k - 2], "bs": [10 * k - 5]} for k in range(1, 200_001)]
    began = time.time()
    found = cut_starts(cuts, 120, 3)
    assert time.time() - began < 5 and found == [10 * k - 2 for k in range(1, 200_001)]
    assert cut_starts([{"i": 2, "hs": [1], "bs": []}, {"i": 9, "hs": [], "bs": [3, 4]}, {"i": 9, "hs": [], "bs": []}], 120, 3) == [2, 9, 9]
