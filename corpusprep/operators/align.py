"""Alignment of two revisions: what was inserted, removed and changed, block by block.

Blocks whose text occurs once in either revision are anchors. The longest chain of anchors that
keeps the order of both revisions is kept; blocks that were moved drop out of it. Between
two anchors the remaining blocks are compared with each other, in pieces of bounded size. So an
inserted block is one insertion, whatever comes after it.

Only digests are shuffled. A document with a giant number of blocks is cut into stretches, in each
of which the chain is longest; chains of later stretches go on after those before them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.operators.scan import STRETCH, Cutting, Run, chosen, in_stretches, running

GAP_ROWS = 512
CHANGES = "array<struct<i:int,j:int,change:string>>"


def longest_rising(values: Sequence[int]) -> list[int]:
    """Places of a longest rising subsequence."""
    tails: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        before.append(at[k - 1] if k else -1)
        if k == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[k], at[k] = v, i
    out = []
    i = at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def compared(a: Sequence[str], b: Sequence[str]) -> list[tuple[int | None, int | None, str]]:
    """``(place in a, place in b, change)`` of two short lists: equal runs first, the rest in pairs."""
    out: list[tuple[int | None, int | None, str]] = []
    i = j = 0
    for x, y, n in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks():
        while i < x and j < y:
            out.append((i, j, "changed"))
            i, j = i + 1, j + 1
        out += [(k, None, "removed") for k in range(i, x)] + [(None, k, "added") for k in range(j, y)]
        out += [(x + k, y + k, "same") for k in range(n)]
        i, j = x + n, y + n
    return out


def _rising(lists: Column) -> Column:
    @F.arrow_udf("array<int>")
    def rising(arrays: pa.Array) -> pa.Array:
        return pa.array([longest_rising(v or []) for v in arrays.to_pylist()], pa.list_(pa.int32()))

    return rising(lists)


def _compared(a: Column, b: Column) -> Column:
    kind = pa.list_(pa.struct([("i", pa.int32()), ("j", pa.int32()), ("change", pa.string())]))

    @F.arrow_udf(CHANGES)
    def pairs(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array([
            [{"i": i, "j": j, "change": c} for i, j, c in compared(x or [], y or [])]
            for x, y in zip(left.to_pylist(), right.to_pylist())], kind)

    return pairs(a, b)


def anchors(old: DataFrame, new: DataFrame, keys: Sequence[str], bits: Cutting) -> DataFrame:
    """``(*keys, a, b)``: positions of unique texts, in a chain that rises on both sides."""
    keys = list(keys)
    once = lambda side, name: side.groupBy(*keys, "__h").agg(
        F.count("*").alias("__n"), F.min("__p").alias(name)).filter("__n = 1").drop("__n")
    pairs = once(old, "a").join(once(new, "b"), [*keys, "__h"]).drop("__h")
    cut = in_stretches(pairs, "a", bits)
    group = [*keys, *([STRETCH] if STRETCH in cut.columns else [])]
    lists = cut.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("__at"))
    kept = lists.withColumn("__kept", _rising(F.col("__at.b"))).select(
        *keys, F.inline(F.transform("__kept", lambda i: F.get("__at", i))))
    if not bits:
        return kept
    far = running(kept, keys, "a", {"__far": Run("max", F.col("b"), inclusive=False)}, bits)
    return far.filter(F.col("__far").isNull() | (F.col("b") > F.col("__far"))).drop("__far")


def _gaps(side: DataFrame, chain: DataFrame, keys: Sequence[str], at: str, rows: int, bits: Cutting) -> DataFrame:
    """Blocks with the number of anchors up to them, and their piece of the gap after it."""
    keys = list(keys)
    marks = chain.select(*keys, F.col(at).alias("__p"), F.lit(1).alias("__anchor"))
    placed = in_stretches(side.join(marks, [*keys, "__p"], "left"), "__p", bits)
    loose = F.when(F.col("__anchor").isNull(), 1).otherwise(0).cast("bigint")
    counted = running(placed, keys, "__p", {
        "__gap": Run("sum", F.col("__anchor").cast("bigint")), "__k": Run("sum", loose, inclusive=False)}, bits)
    begun = running(counted, keys, "__p", {"__begun": Run("last", F.when(F.col("__anchor") == 1, F.col("__k")))}, bits)
    place = F.col("__k") - F.coalesce("__begun", F.lit(0))
    return begun.filter("__anchor IS NULL").select(
        *keys, "__gap", F.floor(place / rows).alias("__piece"), "__p", "__h"
    ).groupBy(*keys, "__gap", "__piece").agg(
        F.array_sort(F.collect_list(F.struct("__p", "__h"))).alias(f"__{at}"))


def align_revisions(
    a: DataFrame, b: DataFrame, keys: Sequence[str], pos: str = "pos", text: str = "text",
    gap_rows: int = GAP_ROWS, bits: Cutting = None,
) -> DataFrame:
    """``(*keys, a_pos, b_pos, change)``: every block of both revisions once.

    ``change`` is ``same``, ``changed`` (what stands in its place is another text), ``removed`` or ``added``; a NULL
    text equals a NULL text. Positions are unique within a revision.
    """
    keys = list(keys)
    side = lambda df: df.select(
        *keys, F.col(pos).cast("bigint").alias("__p"), F.coalesce(tx.digest(text), F.lit("")).alias("__h"))
    old, new = side(a), side(b)
    bits = chosen(old.unionByName(new), keys, bits)
    chain = anchors(old, new, keys, bits)
    left = _gaps(old, chain, keys, "a", gap_rows, bits)
    right = _gaps(new, chain, keys, "b", gap_rows, bits)
    both = left.join(right, [*keys, "__gap", "__piece"], "full")
    changes = both.withColumn("__c", _compared(F.col("__a.__h"), F.col("__b.__h")))
    loose = changes.select(*keys, F.inline(F.transform("__c", lambda c: F.struct(
        F.get("__a", c["i"])["__p"].alias("a_pos"), F.get("__b", c["j"])["__p"].alias("b_pos"), c["change"].alias("change")))))
    fixed = chain.select(*keys, F.col("a").alias("a_pos"), F.col("b").alias("b_pos"), F.lit("same").alias("change"))
    return fixed.unionByName(loose)
