"""Removal of byte strings that start at two places or more, by two-stage suffix sorting.

A byte goes if some string of ``LENGTH`` bytes that covers it starts anywhere else, in the
same document or another. Sorting all suffixes of a corpus would move every suffix with its
context, so suffixes are first grouped by content, without loss:

1. Of the ``ANCHOR``-byte strings inside a window of ``LENGTH`` bytes the one with the least
   hash is the window's anchor. Equal windows have equal anchors at equal offsets, so a
   window whose anchor is unique is unique. Each run of windows with one anchor is a row;
   anchors are counted over the corpus, and rows with unique anchors end here.
2. Rows with one anchor that all have equal bytes repeat as a whole. Of the others one row
   per distinct content is cut out of its text, and the rows of an anchor meet in one task.
3. There the suffixes of all rows are sorted: only suffixes smaller than their successors
   directly, the rest by scanning buckets; then neighbours' common prefixes tell which
   windows repeat.

An anchor with more than ``GROUP`` distinct rows is split: every window reaches at least half
of its free bytes to the left or to the right of the anchor, so each row gives two rows with
longer anchors, and those with unique anchors end. An anchor of ``LENGTH`` bytes needs no
sorting. So no task holds more than ``GROUP`` rows of one anchor.

Cases: a NULL text is the empty one; texts below ``LENGTH`` bytes keep every byte; repeated
rows repeat each other's bytes; an empty table gives an empty result; only the named columns
are kept, so other names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import Rows, short_lived_shuffles, slices, texts
from corpusprep.session import materialise

LENGTH = 200
ANCHOR = 32
GROUP = 4096
SLICE = 1 << 20
PART = 1 << 18
TIE_BITS = 20


def _mixed(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    """Hash of two neighbouring pieces from theirs."""
    h = a * np.uint64(0x9E3779B97F4A7C15 + 2 * level)
    h += b * np.uint64(0xC2B2AE3D27D4EB4F + 2 * level)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


_BYTES = _mixed(np.arange(256, dtype=np.uint64), np.arange(1, 257, dtype=np.uint64), 0)


def window_runs(data: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
    """Runs of windows with one anchor: first window, number, anchor offset, anchor and run hash.

    ``anchor`` is a power of two. The result covers all windows of ``data``.
    """
    h, size, level = _BYTES[data], 1, 0
    at_anchor = None
    while 2 * size <= length:
        h = _mixed(h[:-size], h[size:], level)
        size, level = 2 * size, level + 1
        if size == anchor:
            at_anchor = h
    whole = _mixed(h[:len(h) - (length - size)], h[length - size:], level) if size < length else h
    # The least hash in each window; ties go to the first place.
    place = np.uint64((1 << TIE_BITS) - 1)
    key = (at_anchor & ~place) | np.arange(len(at_anchor), dtype=np.uint64)
    width = length - anchor + 1
    span, low = 1, key
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
    owner = (low & place).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    number = np.diff(np.append(first, len(owner)))
    offset = owner[first] - first
    run = _mixed(whole[first], whole[first + number - 1], 101) + (
        (number * 65_537 + offset).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return first, number, offset, at_anchor[owner[first]], run


def parts_of(size: int, length: int, part: int = PART):
    """Cuts of a text whose windows together are all windows, each once."""
    start = 0
    while start + length <= size:
        yield start, min(size, start + part)
        start += part - length + 1


def anchors(rows: DataFrame, length: int, anchor: int) -> DataFrame:
    """``(h, g, d1, d2, first, number)``: a row per run of windows with one anchor."""

    def run(batches: Rows) -> Rows:
        for batch in batches:
            for piece in slices(batch, "text"):
                d1, d2 = (piece.column(c).to_numpy() for c in ("d1", "d2"))
                found = []
                for i, t in enumerate(texts(piece)):
                    data = np.frombuffer(t, np.uint8)
                    for a, b in parts_of(len(data), length):
                        first, number, _, h, g = window_runs(data[a:b], length, anchor)
                        found.append((h, g, np.full(len(h), i), first + a, number))
                if not found:
                    continue
                h, g, i, first, number = map(np.concatenate, zip(*found))
                yield pa.record_batch(
                    [pa.array(h.view(np.int64)), pa.array(g.view(np.int64)), pa.array(d1[i]), pa.array(d2[i]),
                     pa.array(first), pa.array(number.astype(np.int32))],
                    ["h", "g", "d1", "d2", "first", "number"])

    return rows.select("d1", "d2", "text").mapInArrow(
        run, "h long, g long, d1 long, d2 long, first long, number int")


def suffix_order(text: bytes, depth: int, wanted: np.ndarray | None = None) -> list[int]:
    """Suffixes in order of their first ``depth`` bytes at least, by two-stage sorting.

    With ``wanted``, those suffixes and the ones they are induced from.
    """
    n = len(text)
    a = np.frombuffer(text, np.uint8)
    step = np.append(np.diff(a.astype(np.int16)), -1)
    moves = np.flatnonzero(step)
    smaller = step[moves[np.searchsorted(moves, np.arange(n))]] > 0
    if wanted is None:
        needed = np.ones(n, bool)
    else:
        # A suffix is induced from its successor, and so on up to the next one sorted directly.
        sorted_next = np.minimum.accumulate(np.where(smaller, np.arange(n), n - 1)[::-1])[::-1]
        at = np.flatnonzero(wanted)
        edge = np.bincount(at, minlength=n + 1) - np.bincount(sorted_next[at] + 1, minlength=n + 1)
        needed = np.cumsum(edge)[:n] > 0
    sorted_ = smaller & needed
    direct = sorted(np.flatnonzero(sorted_).tolist(), key=lambda i: text[i:i + depth])
    # A bucket holds the suffixes of one first byte: those above their successors come first.
    sizes = np.bincount(a[needed], minlength=256)
    starts = np.cumsum(sizes) - sizes
    own = np.bincount(a[sorted_], minlength=256)
    order = np.full(int(sizes.sum()), -1)
    if direct:
        placed = np.array(direct)
        rank = np.arange(len(placed)) - np.repeat(np.cumsum(own) - own, own)
        order[np.repeat(starts + sizes - own, own) + rank] = placed
    out, head, induced = order.tolist(), starts.tolist(), (needed & ~smaller).tolist()
    last = n - 1
    if induced[last]:
        out[head[text[last]]] = last
        head[text[last]] += 1
    for i in out:
        j = i - 1
        if j >= 0 and induced[j]:
            c = text[j]
            out[head[c]] = j
            head[c] += 1
    return out


def repeated_starts(regions: list[bytes], numbers: list[int], length: int) -> np.ndarray:
    """For the first ``numbers[i]`` starts of each region: does the ``length``-byte string recur?"""
    text = b"\xff".join(regions) + b"\xff"
    sizes = np.array([len(r) + 1 for r in regions])
    begins = np.cumsum(sizes) - sizes
    numbers = np.asarray(numbers)
    upto = np.cumsum(numbers)
    wanted = np.repeat(begins - (upto - numbers), numbers) + np.arange(int(upto[-1]))
    slot = np.full(len(text), -1)
    slot[wanted] = np.arange(len(wanted))
    order = np.array(suffix_order(text, length, slot >= 0))
    order = order[slot[order] >= 0]
    listed = order.tolist()
    same = [text[i:i + length] == text[j:j + length] for i, j in zip(listed, listed[1:])]
    out = np.zeros(len(wanted), bool)
    hit = np.flatnonzero(same)
    out[slot[order[hit]]] = True
    out[slot[order[hit + 1]]] = True
    return out


REGION = "key long, d1 long, d2 long, first long, number int, at int, alen int, twice boolean, region binary"


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2], edge[1::2] - edge[::2]


def _sorted_groups(rows: DataFrame, length: int) -> DataFrame:
    """``(d1, d2, first, number)`` of the repeated windows among rows with one key."""

    def judge(held: list[tuple]):
        flags = repeated_starts([r[5] for r in held], [r[3] for r in held], length)
        out, at = [], 0
        for d1, d2, first, number, twice, _ in held:
            if not twice:
                for a, n in zip(*_runs(flags[at:at + number])):
                    out.append((d1, d2, first + int(a), int(n)))
            at += number
        names = ["d1", "d2", "first", "number"]
        columns = list(zip(*out)) if out else [[]] * 4
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32()]
        return pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    def run(batches: Rows) -> Rows:
        held, size, key = [], 0, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "d1", "d2", "first", "number", "twice", "region")]
            for k, *row in zip(*columns):
                if k != key and size > SLICE:
                    yield judge(held)
                    held, size = [], 0
                key = k
                held.append(tuple(row))
                size += len(row[5])
        if held:
            yield judge(held)

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(
        run, "d1 long, d2 long, first long, number int")


def _split(rows: DataFrame, length: int) -> DataFrame:
    """Two rows with longer anchors for each row: windows that reach left, and that reach right."""

    def halves(batches: Rows) -> Rows:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                free, at, n = length - r["alen"], r["at"], r["number"]
                near = (free + 1) // 2
                # Window i starts `at - i` bytes before the anchor.
                left = max(0, min(n, at - near + 1))
                if left:
                    out.append((r, 0, left, at - near, r["alen"] + near, 0))
                if left < n:
                    out.append((r, left, n - left, at - left, r["alen"] + free // 2 + (1 if free else 0), 1))
            columns: list[list] = [[] for _ in range(9)]
            for r, skip, n, at, alen, side in out:
                region = r["region"][skip:skip + n + length - 1]
                key = xxhash.xxh64_intdigest(region[at:at + alen], r["key"] + side & (1 << 64) - 1)
                key -= (key >> 63) << 64
                row = (key, r["d1"], r["d2"], r["first"] + skip, n, at, alen, r["twice"], region)
                for column, value in zip(columns, row):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.int32()] * 3 + [pa.bool_(), pa.binary()]
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["key", "d1", "d2", "first", "number", "at", "alen", "twice", "region"])

    return rows.select("key", "d1", "d2", "first", "number", "at", "alen", "twice", "region").mapInArrow(halves, REGION)


def keyed(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The named columns, the text as bytes, and two hashes that stand for its content."""
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        *keep, content.cast("binary").alias("text"), F.xxhash64(content).alias("d1"),
        F.xxhash64(F.lit(1), content).alias("d2"))


def repeated_windows(docs: DataFrame, text: str = "text", length: int = LENGTH, anchor: int = ANCHOR,
                     group: int | None = None) -> DataFrame:
    """``(d1, d2, runs)``: per content with repeats, runs ``(first, number)`` of window starts."""
    group = GROUP if group is None else group
    spark = docs.sparkSession
    rows = keyed(docs, text=text).filter(F.octet_length("text") >= length)
    with short_lived_shuffles(spark):
        found = anchors(rows, length, anchor)
        shared = materialise(
            found.groupBy("h").agg(F.count("*").alias("n"), F.min("g").alias("low"), F.max("g").alias("high"))
            .filter("n > 1").select("h", (F.col("low") != F.col("high")).alias("mixed")), "anchors")
        every = materialise(found.join(shared, "h"), "runs")
        mixed = materialise(
            every.filter("mixed").groupBy("h", "g").agg(
                F.count("*").alias("n"), F.min(F.struct("d1", "d2", "first", "number")).alias("one")), "contents")

        # Contents to sort: those of anchors under which at least one content stands alone.
        per_anchor = mixed.groupBy("h").agg(
            F.count("*").alias("contents"), F.count_if(F.col("n") == 1).alias("alone")).filter("alone > 0")
        wanted = mixed.join(per_anchor, "h").select(
            F.col("h").alias("key"), "one.*", (F.col("n") > 1).alias("twice"),
            (F.col("contents") > group).alias("large"))
        once = keyed(docs, text=text).groupBy("d1", "d2").agg(F.first("text").alias("text"))
        regions = wanted.join(once, ["d1", "d2"]).withColumn(
            "region", F.expr(f"substring(text, cast(first + 1 AS int), number + {length - 1})")).drop("text")
        written = materialise(regions, "regions")
        sorted_ = [materialise(_sorted_groups(written.filter("NOT large"), length), "repeats")]

        large, level = written.filter("large").drop("large"), 0
        if not large.isEmpty():
            large = materialise(_with_anchor_place(large, length, anchor), "regions")
        while not large.isEmpty():
            halves = materialise(_split(large, length), "regions")
            sizes = halves.groupBy("key").agg(
                F.count("*").alias("n"), F.min("alen").alias("least"), F.count_if(~F.col("twice")).alias("alone")
            ).filter("(n > 1 OR alone = 0) AND alone > 0")
            met = materialise(halves.join(sizes, "key"), "regions")
            done = F.col("least") >= length
            sorted_.append(met.filter(done & ~F.col("twice")).select("d1", "d2", "first", "number"))
            sorted_.append(materialise(_sorted_groups(met.filter(~done & (F.col("n") <= group)), length), "repeats"))
            large = met.filter(~done & (F.col("n") > group)).drop("n", "least", "alone")
            level += 1

        alike = every.filter("NOT mixed").select("d1", "d2", "first", "number")
        twice = every.filter("mixed").join(
            mixed.filter("n > 1").select("h", "g"), ["h", "g"]).select("d1", "d2", "first", "number")
        runs = alike.unionByName(twice)
        for more in sorted_:
            runs = runs.unionByName(more)
        return materialise(
            runs.distinct().groupBy("d1", "d2").agg(F.collect_list(F.struct("first", "number")).alias("runs")), "cuts")


def _with_anchor_place(rows: DataFrame, length: int, anchor: int) -> DataFrame:
    """Adds the anchor's place in the region, found as it was for the whole text."""

    def run(batches: Rows) -> Rows:
        for batch in batches:
            # The region's windows are one run: its anchor is the first window's.
            at = []
            for region, number in zip(batch.column("region").to_pylist(), batch.column("number").to_pylist()):
                first, _, offset, _, _ = window_runs(np.frombuffer(region, np.uint8), length, anchor)
                at.append(int(offset[0]))
            yield pa.record_batch(
                [*(batch.column(c) for c in ("key", "d1", "d2", "first", "number")), pa.array(at, pa.int32()),
                 pa.array([anchor] * len(at), pa.int32()), batch.column("twice"), batch.column("region")],
                ["key", "d1", "d2", "first", "number", "at", "alen", "twice", "region"])

    return rows.select("key", "d1", "d2", "first", "number", "twice", "region").mapInArrow(run, REGION)


def cut(data: bytes, runs: list[tuple[int, int]], length: int, characters: bool = False) -> tuple[bytes, int, int]:
    """What is left of a text, the number of removed bytes, and of removed stretches.

    With ``characters`` a stretch grows to the borders of the UTF-8 characters it cuts.
    """
    if not runs:
        return data, 0, 0
    first = np.array([r[0] for r in runs])
    last = first + np.array([r[1] for r in runs]) + length - 1
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    if characters:
        edge = np.append((np.frombuffer(data, np.uint8) & 0xC0) != 0x80, True)
        edges = np.flatnonzero(edge)
        first = edges[np.maximum(np.searchsorted(edges, first, side="right") - 1, 0)]
        last = edges[np.searchsorted(edges, last, side="left")]
    new = np.concatenate([[True], first[1:] > last[:-1]])
    begin, end = first[new], np.append(last[:-1][new[1:]], last[-1])
    kept = b"".join(data[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(data)]))
    return kept, int((end - begin).sum()), len(begin)


def remove_repeats(docs: DataFrame, *keep: str, text: str = "text", length: int = LENGTH,
                   anchor: int = ANCHOR, group: int | None = None, characters: bool = False) -> DataFrame:
    """``(*keep, kept, n_bytes, n_removed, n_spans)`` of every row; ``kept`` as bytes.

    With ``characters`` no character is cut in two: what a cut touches goes as a whole.
    """
    cuts = repeated_windows(docs, text, length, anchor, group)
    rows = keyed(docs, *keep, text=text).join(cuts, ["d1", "d2"], "left").select(*keep, "text", "runs")

    def run(batches: Rows) -> Rows:
        for batch in batches:
            for piece in slices(batch, "text"):
                done = []
                for t, runs in zip(texts(piece), piece.column("runs").to_pylist()):
                    done.append((*cut(t, [(r["first"], r["number"]) for r in runs or ()], length, characters), len(t)))
                kept, removed, spans, sizes = zip(*done)
                yield pa.record_batch(
                    [*(piece.column(k) for k in keep), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()),
                     pa.array(removed, pa.int64()), pa.array(spans, pa.int64())],
                    [*keep, "kept", "n_bytes", "n_removed", "n_spans"])

    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    return rows.mapInArrow(run, f"{kinds}, kept binary, n_bytes long, n_removed long, n_spans long")
