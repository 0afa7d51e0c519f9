"""Numbered rows and ranges that come as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.operators.lookup import lookup
from corpusprep.operators.scan import Cutting, Run, chosen, in_stretches, running

LEVELS = 61


def nodes_of(first: Column, last: Column) -> Column:
    """The dyadic intervals ``(level, node)`` that make up ``[first, last]``, at most two per level.

    Interval ``(l, n)`` holds the numbers whose shift by ``l`` is ``n``; each number of the range lies in
    exactly one of them.
    """
    def at(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
        low = F.call_function("shiftright", first + size - 1, level)
        high = F.call_function("shiftright", last + 1, level)
        own = lambda node: F.struct(level.alias("level"), node.alias("node"))
        return F.array(
            F.when((low < high) & (low.bitwiseAND(F.lit(1)) == 1), own(low)),
            F.when((low < high) & (high.bitwiseAND(F.lit(1)) == 1), own(high - 1)))

    # No interval is wider than the range.
    widest = F.ceil(F.log2(F.greatest(last - first + 2, F.lit(1)).cast("double"))).cast("int")
    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.least(widest, F.lit(LEVELS))), at)))


def in_ranges(
    rows: DataFrame, ranges: DataFrame, number: str, keys: Sequence[str], row_id: Sequence[str],
    first: str = "first", last: str = "last", **skew: int,
) -> DataFrame:
    """Each row with every range ``[first, last]`` of its keys that holds its number.

    A range is cut into dyadic intervals, a number asks for the intervals it lies in, one per level in use: the
    join is on equality, finds each pair once and needs no test afterwards. Rows with equal numbers and keys
    ask once, only ranges of keys that are asked for are cut, and numbers that many rows have are salted.
    Rows without a number or key, and empty ranges, match nothing. Numbers are below ``2**61``.
    """
    keys = list(keys)
    low, high = F.col(first).cast("bigint"), F.col(last).cast("bigint")
    at = F.col(number).cast("bigint")
    points = rows.filter(at.isNotNull()).select(*keys, at.alias("__at")).distinct()
    wanted = ranges.join(points.select(*keys).distinct(), keys, "left_semi")
    cut = wanted.select("*", F.inline(nodes_of(low, high)).alias("__level", "__node"))
    levels = sorted(r["__level"] for r in cut.select("__level").distinct().collect())
    if not levels:
        return rows.join(ranges, keys, "inner").limit(0)
    asked = F.array(*[
        F.struct(F.lit(v).alias("__level"), F.shiftright("__at", v).alias("__node")) for v in levels])
    asking = points.select("*", F.inline(asked))
    found = lookup(asking, cut, [*keys, "__level", "__node"], [*keys, "__at"], "inner", **skew).drop("__level", "__node")
    return lookup(rows.filter(at.isNotNull()).withColumn("__at", at), found, [*keys, "__at"], row_id, "inner", **skew).drop("__at")


def past_end(rows: DataFrame, ranges: DataFrame, number: str, keys: Sequence[str], last: str = "last") -> DataFrame:
    """Ranges that end past the last number of their keys, with it as ``n_numbers`` (NULL: no rows)."""
    sizes = rows.groupBy(*keys).agg(F.max(number).alias("n_numbers"))
    return ranges.join(sizes, list(keys), "left").filter(
        F.col("n_numbers").isNull() | (F.col(last) > F.col("n_numbers")))


def merged_labels(
    ranges: DataFrame, keys: Sequence[str], part_ranges: int = 1000, bits: Cutting = None,
) -> DataFrame:
    """The ranges of every merged range, in order: ``(*keys, s, part, ranges)``.

    ``s`` is where the merged range starts; its ranges, as ``(s, e, label, n)`` in that order and ``n`` the
    number of equal ones, come in numbered parts of at most ``part_ranges``.
    """
    keys = list(keys)
    bits = chosen(ranges, keys, bits)
    counted = ranges.groupBy(*keys, "s", "e", "label").agg(F.count("*").alias("n"))
    starts = counted.groupBy(*keys, "s").agg(F.max("e").alias("__e"), F.count("*").alias("__here"))
    reach = running(in_stretches(starts, "s", bits), keys, "s", {
        "__far": Run("max", F.col("__e"), inclusive=False),
        "__before": Run("sum", F.col("__here"), inclusive=False)}, bits)
    opens = F.col("__far").isNull() | (F.col("s") > F.col("__far"))
    placed = running(reach, keys, "s", {
        "__island": Run("last", F.when(opens, F.col("s"))),
        "__first": Run("last", F.when(opens, F.col("__before")))}, bits)
    # Places within a start are counted apart from the starts, so one start may hold any share of the ranges.
    here = Window.partitionBy(*keys, "s").orderBy("e", "label")
    own = counted.withColumn("__i", F.row_number().over(here) - 1)
    listed = own.join(placed.select(*keys, "s", "__island", (F.col("__before") - F.col("__first")).alias("__at")), [*keys, "s"])
    part = F.floor((F.col("__at") + F.col("__i")) / part_ranges).cast("int")
    return listed.groupBy(*keys, F.col("__island").alias("__start"), part.alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("s", "e", "label", "n"))).alias("ranges")
    ).withColumnRenamed("__start", "s")
