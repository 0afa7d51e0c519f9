"""Near-duplicates by SimHash, compared in bit slices.

A fingerprint has 64 bits over the XXH64 hashes of a text's word shingles. Distinct
fingerprints are put into the buckets of all choices of ``PARTS - radius`` of ``PARTS``
bit ranges: two fingerprints within the radius share at least one bucket. In a bucket,
up to 64 fingerprints form a slab that holds bit planes, one machine word per plane and
a lane per fingerprint. A fingerprint meets a slab plane by plane; carry-save counters
sum all lanes' distances at once, and a pair of fingerprint and slab is given up as soon
as every lane is beyond the radius. Buckets above ``CHUNK`` are cut into chunks whose
pairs are compared as tasks of their own, so no task holds more than two chunks.

Buckets give spanning forests, not pairs; components of the fingerprint graph are
found by alternating large-star and small-star steps on written tables.

Cases: NULL and word-less texts have fingerprint zero and link like any other; repeated
rows share a component; a NULL id never becomes a component's id, and a component
without any id has a NULL one; an empty table gives an empty result; other columns of the
input are not read. A text is fingerprinted whole, however long, with memory in proportion to it;
a bit that is set in exactly half of the hashes is 0.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import Rows, as_bytes, map_slices, texts
from corpusprep.session import materialise

SEED = 42
WIDTH = 3
RADIUS = 3
PARTS = 5
CHUNK = 2048
LANES = 64
STEP = 8
WORK = 1 << 17


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """The SimHash of one text; a bit is set where over half the hashes set it."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(width)))))
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, len(shingles))
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = hashes[a:a + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``(doc, fp)`` of every row, ``fp`` as a signed number."""
    kind = docs.schema[doc].dataType.simpleString()

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        got = np.array([fingerprint(t, width) for t in texts(piece)], np.uint64).view(np.int64)
        return pa.record_batch([piece.column(0), pa.array(got)], [doc, "fp"])

    return map_slices(as_bytes(docs, doc, text=text), "text", run, f"`{doc}` {kind}, fp long")


def bit_ranges(parts: int) -> list[int]:
    """Masks of ``parts`` ranges that cover 64 bits."""
    edges = [64 * i // parts for i in range(parts + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def in_buckets(fps: DataFrame, radius: int, parts: int) -> DataFrame:
    """``(bucket, part, fp)``: a row per choice of ranges that a near fingerprint may share."""
    masks = [sum(c) for c in combinations(bit_ranges(parts), parts - radius)]
    keys = [F.struct(F.lit(i).alias("bucket"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part"))
            for i, m in enumerate(masks)]
    return fps.select("fp", F.explode(F.array(*keys)).alias("__k")).select("__k.bucket", "__k.part", "fp")


def near_pairs(fps: np.ndarray, group: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions within the radius in the same group.

    ``group`` is ascending. Rows of side 0 and 1 are paired across the sides; rows of
    side 2 among themselves.
    """
    n = len(fps)
    planes_of = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
    # Slabs: runs of up to 64 rows of one group and side.
    order = np.lexsort((np.arange(n), side, group))
    g, s = group[order], side[order]
    new = np.ones(n, bool)
    new[1:] = (g[1:] != g[:-1]) | (s[1:] != s[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    lane = (np.arange(n) - head) % LANES
    slab_first = np.flatnonzero(lane == 0)
    slab = np.cumsum(lane == 0) - 1
    slabs = len(slab_first)
    bit = np.left_shift(np.uint64(1), lane.astype(np.uint64))
    planes = np.zeros((64, slabs), np.uint64)
    shown = planes_of[order]
    for k in range(64):
        planes[k] = np.bitwise_or.reduceat(np.where(shown[:, k], bit, np.uint64(0)), slab_first)
    full = np.bitwise_or.reduceat(bit, slab_first)
    # A row meets the slabs of its group from its own on (side 2), or those of side 1 (side 0).
    slab_group, slab_side = g[slab_first], s[slab_first]
    begin = np.searchsorted(slab_group, g, side="left")
    end = np.searchsorted(slab_group, g, side="right")
    start = np.where(s == 2, slab, begin)
    start = np.where(s == 0, begin + _ones_before(slab_group, slab_side, begin, end), start)
    count = np.where(s == 1, 0, end - start)
    left, right = [], []
    upto = np.cumsum(count)
    a = 0
    while a < n:
        floor = upto[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(upto, floor + WORK, side="right")))
        rows = np.repeat(np.arange(a, b), count[a:b])
        meets = np.repeat(start[a:b] - (upto[a:b] - count[a:b]), count[a:b]) + np.arange(floor, upto[b - 1])
        i, j = _within(shown, planes, full, rows, meets, radius, slab, lane)
        left.append(order[i])
        right.append(order[slab_first[j >> 6] + (j & 63)])
        a = b
    return np.concatenate(left or [np.empty(0, int)]), np.concatenate(right or [np.empty(0, int)])


def _ones_before(slab_group, slab_side, begin, end):
    """Slabs of side 0 that stand before those of side 1 in each group."""
    zeros = np.concatenate([[0], np.cumsum(slab_side == 0)])
    return zeros[end] - zeros[begin]


def _within(shown, planes, full, rows, meets, radius, slab, lane):
    """Row and lane (slab * 64 + lane) of the pairs within the radius."""
    counter = [np.zeros(len(rows), np.uint64) for _ in range(max(1, int(radius).bit_length()))]
    over = np.zeros(len(rows), np.uint64)
    limit = (1 << len(counter)) - 1
    for first in range(0, 64, STEP):
        for k in range(first, first + STEP):
            carry = planes[k][meets] ^ np.where(shown[rows, k], ~np.uint64(0), np.uint64(0))
            for level, digit in enumerate(counter):
                counter[level], carry = digit ^ carry, digit & carry
            over |= carry
        if radius < limit:
            over |= _beyond(counter, radius)
        alive = (over & full[meets]) != full[meets]
        if not alive.all():
            rows, meets, over = rows[alive], meets[alive], over[alive]
            counter = [c[alive] for c in counter]
        if not len(rows):
            break
    hit = full[meets] & ~over
    # A row of a slab does not meet itself or an earlier lane of its own slab.
    own = slab[rows] == meets
    later = ~((np.left_shift(np.uint64(2), lane[rows].astype(np.uint64))) - np.uint64(1))
    hit = np.where(own, hit & later, hit)
    some = hit != 0
    rows, meets, hit = rows[some], meets[some], hit[some]
    bits = np.unpackbits(hit.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, where = np.nonzero(bits)
    return rows[at], (meets[at].astype(np.int64) << 6) | where


def _beyond(counter, radius):
    """Lanes whose count is above the radius."""
    above, equal = np.uint64(0), ~np.uint64(0)
    for level in reversed(range(len(counter))):
        if radius >> level & 1:
            equal = equal & counter[level]
        else:
            above = above | (equal & counter[level])
            equal = equal & ~counter[level]
    return above


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest node it is linked with, over any number of steps."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        open_ = la != lb
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def links(fps: DataFrame, radius: int = RADIUS, parts: int = PARTS, chunk: int = CHUNK) -> DataFrame:
    """Edges ``(fp, root)`` that join all fingerprints within the radius; few per bucket."""
    rows = in_buckets(fps, radius, parts)
    sizes = rows.groupBy("bucket", "part").count()
    large = sizes.filter(F.col("count") > chunk).select(
        "bucket", "part", F.ceil(F.col("count") / chunk).cast("int").alias("chunks"))
    marked = rows.join(large, ["bucket", "part"], "left")
    mine = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("chunks")).cast("int")
    whole = marked.filter("chunks IS NULL").select(
        "bucket", "part", F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(2).alias("side"), "fp")
    # A chunk of a large bucket meets itself and every other chunk once.
    cut = marked.filter("chunks IS NOT NULL").withColumn("mine", mine).select(
        "bucket", "part", "mine", "fp", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    cut = cut.select(
        "bucket", "part", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"),
        F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1).alias("side"),
        "fp")
    placed = whole.unionByName(cut).select(
        F.xxhash64("bucket", "part", "x", "y").alias("place"), "bucket", "part", "x", "y", "side", "fp")
    placed = placed.repartition("place").sortWithinPartitions("place", "bucket", "part", "x", "y")

    def compare(batches: Rows) -> Rows:
        for table in _whole_groups(batches):
            keys = [table.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "part", "x", "y")]
            new = np.ones(table.num_rows, bool)
            new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
            group = np.cumsum(new) - 1
            shared = np.bincount(group)[group] > 1
            if not shared.any():
                continue
            fp = table.column("fp").to_numpy(zero_copy_only=False)[shared]
            side = table.column("side").to_numpy(zero_copy_only=False)[shared]
            a, b = near_pairs(fp.view(np.uint64), group[shared], side, radius)
            root = forest(len(fp), a, b)
            leaf = np.flatnonzero(root != np.arange(len(fp)))
            yield pa.record_batch([pa.array(fp[leaf]), pa.array(fp[root[leaf]])], ["fp", "root"])

    return placed.mapInArrow(compare, "fp long, root long").distinct()


def _whole_groups(batches: Rows):
    """Tables that end where a place ends; places are small, so little is held back."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        place = batch.column("place").to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(place, place[-1], side="left"))
        if last == 0 and held and held[-1].column("place")[-1].as_py() == place[-1]:
            held.append(batch)
            continue
        if last == 0 and not held:
            held = [batch]
            continue
        yield pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks()
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of all nodes on edges ``(a, b)``: the smallest node they reach.

    Alternating large-star and small-star steps; each is written to the shared folder.
    """
    now = materialise(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges")
    before = None
    while before is None or before[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        under = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(under, "a").select(
            F.explode(F.array(
                F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.*").filter("a <> b").distinct()
        now = materialise(small, "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", width: int = WIDTH,
    radius: int = RADIUS, parts: int = PARTS, chunk: int | None = None,
) -> DataFrame:
    """``(doc, fp, component_id)`` of every row; the id is the smallest one reachable."""
    marks = materialise(fingerprints(docs, doc, text, width), "fingerprints")
    distinct = materialise(marks.groupBy("fp").agg(F.min(doc).alias("low")), "distinct")
    edges = links(distinct.select("fp"), radius, parts, CHUNK if chunk is None else chunk)
    roots = components(edges.select(F.col("fp").alias("a"), F.col("root").alias("b")))
    placed = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    named = placed.join(lowest, "root").select("fp", "component_id")
    return marks.join(named, "fp").select(doc, "fp", "component_id")


def keep_one(docs: DataFrame, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that give their component its id, each once; columns as they came.

    A component without ids keeps one row per distinct text.
    """
    found = near_duplicates(docs, doc, text, **options)
    kept = found.filter(F.col(doc) == F.col("component_id")).groupBy(doc).agg(F.count("*").alias("__n"))
    rows = docs.join(kept, doc)
    once = rows.filter("__n = 1").drop("__n")
    again = rows.filter("__n > 1").drop("__n").dropDuplicates([doc])
    lost = docs.filter(F.col(doc).isNull())
    unnamed = found.filter(F.col(doc).isNull() & F.col("component_id").isNull()).select("fp").distinct()
    firsts = lost.dropDuplicates([text])
    marked = fingerprints(firsts.select(F.col(text).alias("__t"), F.col(text)), "__t", text, options.get("width", WIDTH))
    alone = marked.join(unnamed, "fp").select("__t")
    alone = firsts.join(alone, F.col(text).eqNullSafe(F.col("__t"))).drop("__t")
    return once.unionByName(again).unionByName(alone).select(*docs.columns)
