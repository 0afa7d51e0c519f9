"""Cutting texts into chunks and packing segments into batches."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.operators.folds import UNBOUNDED, stateful_fold
from corpusprep.operators.scan import Cutting, chosen, numbered

# Service limits the defaults derive from.
CHUNK_CHARS = 9000
BATCH_CHARS = max(600, min(CHUNK_CHARS // 2, 3500))
SEGMENT_OVERHEAD = 32
PAGES_PER_CHUNK = 50


def cut_points(text: str, limit: int, heading: re.Pattern) -> list[int]:
    """End offsets of the chunks of one text.

    A chunk holds at most ``limit`` characters. It ends after the last blank
    line that fits, else after the last line that fits, else where it is full.
    A line end is unfit if the last line with text before it is a heading: the
    chunk then ends one line earlier than the line above that heading, as long
    as that leaves a line in it.
    """
    lines = text.split("\n")
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    ends = (np.cumsum(sizes + 1) - 1)[:-1].tolist()
    blank_after = [i for i in range(len(ends) - 1) if not lines[i + 1]]
    blank_ends = [ends[i] for i in blank_after]
    shown = [line.rstrip() for line in lines]
    title = [bool(s) and heading.match(s) is not None for s in shown]
    # The last line with text up to each line.
    spoken = np.maximum.accumulate(np.where([bool(s) for s in shown], np.arange(len(lines)), -1)).tolist()

    def fit(line: int, first: int, start: int) -> int:
        above = spoken[line]
        while above > first and title[above] and above >= 2 and ends[above - 2] > start:
            line = above - 2
            above = spoken[line]
        return line

    out, start = [], 0
    while len(text) - start > limit:
        stop = start + limit
        at = bisect_right(blank_ends, stop - 2) - 1
        line = blank_after[at] if at >= 0 and blank_ends[at] > start else bisect_right(ends, stop - 1) - 1
        if line >= 0 and ends[line] > start:
            stop = ends[fit(line, bisect_left(ends, start), start)] + 1
        out.append(stop)
        start = stop
    if start < len(text) or not out:
        out.append(len(text))
    return out


def chunk_text(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", limit: int = CHUNK_CHARS,
    heading: str = r"#+\s",
) -> DataFrame:
    """Rows ``(doc, chunk_no, chunk)``; each text is read once and never leaves its row.

    A NULL text is one NULL chunk, so no document is lost.
    """

    @F.pandas_udf("array<string>")
    def cut(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        rule = re.compile(heading)
        for batch in texts:
            out = []
            for t in batch:
                ends = [] if t is None else cut_points(t, limit, rule)
                out.append([t[a:b] for a, b in zip([0, *ends], ends)])
            yield pd.Series(out, index=batch.index)

    short = F.coalesce(F.length(text) <= limit, F.lit(True))
    # Texts within the limit stay in the JVM as their own single chunk.
    single = docs.filter(short).select(doc, F.lit(0).alias("chunk_no"), F.col(text).alias("chunk"))
    many = docs.filter(~short).select(doc, F.posexplode(cut(text)).alias("chunk_no", "chunk"))
    return single.unionByName(many)


def fixed_chunks(
    rows: DataFrame, keys: Sequence[str], pos: str, size: int = PAGES_PER_CHUNK, bits: Cutting = None
) -> DataFrame:
    """Chunk number by position: ``size`` rows each, from 1."""
    dense = numbered(rows, keys, pos, "__rn", bits=bits)
    return dense.withColumn("chunk_no", (F.floor(F.col("__rn") / size) + 1).cast("bigint")).drop("__rn")


def _pack_transfer(limit: int):
    def transfer(w: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        n = len(w)
        upto = np.concatenate([[0], np.cumsum(w)])
        total = int(upto[n])
        # jump[i]: where the batch that begins at row i is closed (n if it is still open).
        jump = np.searchsorted(upto, upto[:-1] + limit, side="right") - 1
        jump = np.maximum(jump, np.arange(n) + 1)
        first = int(np.searchsorted(upto[1:], limit, side="right"))
        heads = np.arange(min(first, n - 1) + 1)
        at, count = heads.copy(), np.zeros(len(heads), dtype=np.int64)
        live = jump[at] < n
        while live.any():
            at[live] = jump[at[live]]
            count[live] += 1
            live = jump[at] < n
        fill = total - upto[at]
        rows = []
        # An empty batch takes the first row whatever its size.
        rows.append((0, 0, int(fill[0]), 0, int(count[0])))
        top = limit
        for i in heads:
            # Entering fills in (limit - upto[i+1], limit - upto[i]] overflow first at row i.
            low = max(limit - int(upto[i + 1]) + 1, 1)
            if low <= top:
                rows.append((low, top, int(fill[i]), 0, int(count[i]) + 1))
                top = low - 1
        if top >= 1:
            rows.append((1, top, total, 1, 0))
        # A single oversized row leaves a fill beyond the limit: the next row overflows.
        rows.append((limit + 1, UNBOUNDED, int(fill[0]), 0, int(count[0]) + 1))
        return rows

    return transfer


def _pack_apply(limit: int):
    def apply(w: np.ndarray, state: int, emitted: int) -> np.ndarray:
        out = np.empty(len(w), dtype=np.int64)
        for i, size in enumerate(w.tolist()):
            if state and state + size > limit:
                emitted, state = emitted + 1, 0
            state += size
            out[i] = emitted
        return out

    return apply


def pack_batches(
    segments: DataFrame, keys: Sequence[str], size: Column, pos: str = "pos",
    limit: int = BATCH_CHARS, overhead: int = SEGMENT_OVERHEAD, bits: Cutting = None,
) -> DataFrame:
    """Greedy batches in order: ``(*keys, pos, batch)``, batches from 0.

    A segment opens a new batch when it would bring the running one over ``limit``.
    """
    if overhead < 1:
        raise ValueError("overhead must be positive")
    weighed = segments.select(*keys, pos, (size + overhead).cast("bigint").alias("__w"))
    return stateful_fold(
        weighed, keys, pos, "__w", 0, _pack_transfer(limit), _pack_apply(limit), "batch", bits
    )


def _cross_transfer(level: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Levels are page // width; in state ``c`` the next line at level >= c crosses."""
    top = int(level.max(initial=0))
    entering = np.arange(1, top + 1)
    state = entering.copy()
    for q in level.tolist():
        state += state <= q
    rows = [(int(c), int(c), int(s), 0, int(s - c)) for c, s in zip(entering, state)]
    return [*rows, (top + 1, UNBOUNDED, 0, 1, 0)]


def _cross_apply(level: np.ndarray, state: int, emitted: int) -> np.ndarray:
    out = np.zeros(len(level), dtype=np.int64)
    for i, q in enumerate(level.tolist()):
        if q >= state:
            out[i] = state
            state += 1
    return out


def cut_starts(cuts: Sequence[dict], back: int, min_lines: int) -> list[int]:
    """Where the pieces after the first begin, in one pass over a document's crossings."""
    out: list[int] = []
    begun = 0
    for cut in cuts:
        lowest = max(begun + 1, cut["i"] - back)
        heads = [p for p in cut["hs"] if p >= lowest and p > begun + min_lines]
        blanks = [p + 1 for p in cut["bs"] if p >= lowest and p + 1 > begun + min_lines]
        begun = heads[-1] if heads else blanks[-1] if blanks else cut["i"]
        out.append(begun)
    return out


def _cut_starts(cuts: str, back: int, min_lines: int) -> Column:
    @F.arrow_udf("array<bigint>")
    def starts(batch: pa.Array) -> pa.Array:
        return pa.array([cut_starts(row or [], back, min_lines) for row in batch.to_pylist()], pa.list_(pa.int64()))

    return starts(F.col(cuts))


def split_in_order(
    lines: DataFrame, keys: Sequence[str], heading: Column, blank: Column, pos: str = "pos",
    pages: str = "page", width: int = PAGES_PER_CHUNK, back: int = 120, min_lines: int = 3,
    bits: Cutting = None,
) -> DataFrame:
    """Sequential page split: ``(*keys, start_page, end_page, first_line, n_lines)``.

    Each line whose page reaches the next boundary consumes one boundary. The
    cut moves back at most ``back`` lines to a heading, else to after a blank
    line, never leaving fewer than ``min_lines`` behind.
    """
    keys = list(keys)
    bits = chosen(lines, keys, bits)
    dense = numbered(lines, keys, pos, "__i", bits=bits).select(
        *keys, "__i", F.col(pages).alias("__page"),
        F.coalesce(heading, F.lit(False)).alias("__h"), F.coalesce(blank, F.lit(False)).alias("__b"),
    )
    # Lines below the first boundary can never cross, so they stay out of the fold.
    levels = dense.filter(F.col("__page") >= width).select(
        *keys, "__i", F.floor(F.col("__page") / width).cast("bigint").alias("__q")
    )
    crossing = stateful_fold(
        levels, keys, "__i", "__q", 1, _cross_transfer, _cross_apply, "__j", bits
    ).filter("__j > 0")

    # Lines a cut may move back to, met by bucket: at most 2 * (back + 1) per crossing.
    bucket = F.floor(F.col("__at") / (back + 1))
    spots = dense.filter("__h OR __b").select(
        *keys, F.col("__i").alias("__at"), "__h", "__b"
    ).withColumn("__bucket", bucket)
    own = F.floor(F.col("__i") / (back + 1))
    asks = crossing.withColumn("__bucket", F.explode(F.array(own, own - 1)))
    near = (
        asks.join(spots, [*keys, "__bucket"])
        .filter((F.col("__at") <= F.col("__i")) & (F.col("__at") >= F.col("__i") - back))
        .groupBy(*keys, "__i", "__j")
        .agg(
            F.array_sort(F.collect_list(F.when(F.col("__h"), F.col("__at")))).alias("hs"),
            F.array_sort(F.collect_list(F.when(F.col("__b"), F.col("__at")))).alias("bs"),
        )
    )
    # One row per crossing, and a key crosses each boundary once: this list is as
    # long as the document has page chunks, and is gone through once.
    cuts = (
        crossing.join(near, [*keys, "__i", "__j"], "left")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct(
            F.col("__j").alias("j"), F.col("__i").alias("i"),
            F.coalesce("hs", F.array().cast("array<bigint>")).alias("hs"),
            F.coalesce("bs", F.array().cast("array<bigint>")).alias("bs"),
        ))).alias("__cuts"))
    )

    starts = cuts.select(*keys, _cut_starts("__cuts", back, min_lines).alias("__starts"))
    ends = dense.groupBy(*keys).agg(
        F.count("*").alias("__n"), F.coalesce(F.max("__page"), F.lit(0)).alias("__max")
    )
    framed = ends.join(starts, keys, "left").withColumn(
        "__starts", F.concat(F.array(F.lit(0).cast("bigint")),
                             F.coalesce("__starts", F.array().cast("array<bigint>"))))
    pieces = framed.select(*keys, "__n", "__max", "__starts",
                           F.posexplode("__starts").alias("__k", "first_line"))
    last = F.col("__k") == F.size("__starts") - 1
    stop = F.when(last, F.col("__n")).otherwise(F.get("__starts", F.col("__k") + 1))
    begin = (F.col("__k") * width).cast("int")
    end = F.when(~last | (F.col("__max") < begin), begin + width - 1).otherwise(F.col("__max"))
    return pieces.select(
        *keys, begin.alias("start_page"), end.cast("int").alias("end_page"), "first_line",
        (stop - F.col("first_line")).alias("n_lines"),
    ).filter("n_lines > 0")
