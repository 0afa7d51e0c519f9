"""Running computations over ordered rows that survive a giant key.

A plain ``PARTITION BY key ORDER BY pos`` window puts every row of a key in one
task. That is the best plan as long as no key is giant, so it is taken where

* the input is known to be small (its size estimate is below ``WHOLE_BYTES``: a
  key cannot be larger than its table), or
* a count per key, a partial aggregate over the key columns alone, finds no key
  with ``2**BITS`` rows.

Otherwise the rows of the giant keys are cut into stretches of ``2**BITS``
consecutive positions (``pos`` is unique within a key, so a stretch is bounded by
that many rows). Windows run inside a stretch, one summary row per stretch is
folded along the key, and the carried value is joined back on ``(key,
stretch)``. Only the summaries, never the rows, of a giant key meet in one task;
all other keys are handled whole, and take no part in the summaries.

Keys must not be NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusprep.operators.lookup import estimated_bytes
from corpusprep.session import materialise, settled

BITS = 18
HOT_KEYS = 100_000
WHOLE_BYTES = 64 << 20
STRETCH = "__stretch"


@dataclass(frozen=True)
class Run:
    """A running aggregate: ``max``, ``min``, ``sum`` or ``last`` (non-null)."""

    kind: str
    value: Column
    inclusive: bool = True
    backward: bool = False


_FOLD = {"max": F.max, "min": F.min, "sum": F.sum}


@dataclass(frozen=True)
class Cut:
    """Cut the keys in ``hot`` into stretches and leave the others whole.

    ``hot`` is a written table of at most ``HOT_KEYS`` keys, so it can be broadcast.
    """

    bits: int
    hot: DataFrame
    keys: tuple[str, ...]


Cutting = int | Cut | None
"""How to cut keys: an integer cuts all of them into ``2**bits`` positions (0: none),
``None`` decides by the input."""


def chosen(df: DataFrame, keys: Sequence[str], bits: Cutting) -> int | Cut:
    """The cutting for a chain of scans over ``df``; it also holds for longer keys."""
    if bits is not None:
        return bits
    if estimated_bytes(df) <= WHOLE_BYTES:
        return 0
    keys = list(keys)
    counts = df.groupBy(*keys).count().filter(F.col("count") >= 1 << BITS)
    largest = counts.orderBy(F.desc("count"), *keys).limit(HOT_KEYS).select(*keys)
    hot = materialise(largest, "hot-keys")
    return 0 if hot.isEmpty() else Cut(BITS, hot, tuple(keys))


def width(cutting: int | Cut) -> int:
    return cutting.bits if isinstance(cutting, Cut) else cutting


def in_stretches(df: DataFrame, pos: str, cutting: int | Cut) -> DataFrame:
    """Add the stretch of each row, NULL where its key is handled whole.

    A chain of scans adds it once: as long as the column is kept, later windows
    find their rows partitioned and sorted already. Filters on it are filters on a
    partition column, so summaries never touch the rows of other keys.
    """
    if not cutting or STRETCH in df.columns:
        return df
    at = F.shiftright(F.col(pos).cast("bigint"), width(cutting))
    if not isinstance(cutting, Cut):
        return df.select("*", at.alias(STRETCH))
    hot = F.broadcast(cutting.hot.withColumn("__hot", F.lit(True)))
    tagged = df.join(hot, list(cutting.keys), "left")
    return tagged.select(*df.columns, F.when(F.col("__hot"), at).alias(STRETCH))


def _ordered(keys: Sequence[str], by: str, backward: bool):
    return Window.partitionBy(*keys).orderBy(F.desc(by) if backward else F.asc(by))


def _over(run: Run, value: str, window) -> Column:
    if run.kind == "last":
        return F.last(value, ignorenulls=True).over(window)
    return _FOLD[run.kind](value).over(window)


def _summary(run: Run, value: str, pos: str) -> Column:
    if run.kind == "last":
        at = F.when(F.col(value).isNotNull(), F.col(pos))
        return (F.min_by if run.backward else F.max_by)(F.col(value), at)
    return _FOLD[run.kind](value)


def _filled(run: Run, value: Column) -> Column:
    return F.coalesce(value, F.lit(0)) if run.kind == "sum" else value


def _merge(run: Run, near: Column, far: Column) -> Column:
    if run.kind == "max":
        return F.greatest(near, far)
    if run.kind == "min":
        return F.least(near, far)
    if run.kind == "sum":
        return F.coalesce(near, F.lit(0)) + F.coalesce(far, F.lit(0))
    return F.coalesce(near, far)


def running(
    df: DataFrame, keys: Sequence[str], pos: str, runs: Mapping[str, Run], bits: Cutting = None
) -> DataFrame:
    """Add one column per entry of ``runs``."""
    keys = list(keys)
    names = list(runs)
    given = df.columns
    bits = chosen(df, keys, bits)
    if not bits:
        return df.select("*", *[
            _filled(run, _over(run, run.value, _ordered(keys, pos, run.backward).rowsBetween(
                Window.unboundedPreceding, 0 if run.inclusive else -1))).alias(n)
            for n, run in runs.items()
        ])
    df = settled(df)
    valued = in_stretches(
        df.select("*", *[runs[n].value.alias(f"__v_{n}") for n in names]), pos, bits)

    local = []
    for n in names:
        run = runs[n]
        frame = _ordered([*keys, STRETCH], pos, run.backward).rowsBetween(
            Window.unboundedPreceding, 0 if run.inclusive else -1
        )
        local.append(_over(run, f"__v_{n}", frame).alias(f"__l_{n}"))
    rows = [c for c in given if c != STRETCH]
    near = valued.select(*rows, STRETCH, *local)

    summary = valued.filter(F.col(STRETCH).isNotNull()).groupBy(*keys, STRETCH).agg(
        *[_summary(runs[n], f"__v_{n}", pos).alias(f"__s_{n}") for n in names]
    )
    carried = [
        _over(
            runs[n],
            f"__s_{n}",
            _ordered(keys, STRETCH, runs[n].backward).rowsBetween(Window.unboundedPreceding, -1),
        ).alias(f"__c_{n}")
        for n in names
    ]
    far = summary.select(*keys, STRETCH, *carried)

    return near.join(far, [*keys, STRETCH], "left").select(
        *given,
        *[_merge(runs[n], F.col(f"__l_{n}"), F.col(f"__c_{n}")).alias(n) for n in names],
    )


def with_extremes(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    extremes: Mapping[str, tuple[str, Column]],
    bits: Cutting = None,
) -> DataFrame:
    """Attach whole-key extremes, ``{name: ("max" | "min", value)}``, to every row."""
    keys = list(keys)
    given = df.columns
    bits = chosen(df, keys, bits)
    if not bits:
        whole = Window.partitionBy(*keys)
        return df.select("*", *[
            _FOLD[kind](value).over(whole).alias(n) for n, (kind, value) in extremes.items()])
    df = settled(df)
    cut = in_stretches(df, pos, bits)
    here = Window.partitionBy(*keys, STRETCH)
    rows = [c for c in given if c != STRETCH]
    near = cut.select(
        *rows, STRETCH, *[_FOLD[kind](value).over(here).alias(n) for n, (kind, value) in extremes.items()])
    per_stretch = cut.filter(F.col(STRETCH).isNotNull()).groupBy(*keys, STRETCH).agg(
        *[_FOLD[kind](value).alias(n) for n, (kind, value) in extremes.items()])
    whole = Window.partitionBy(*keys)
    far = per_stretch.select(*keys, STRETCH, *[
        _FOLD[kind](n).over(whole).alias(f"__f_{n}") for n, (kind, _) in extremes.items()])
    return near.join(far, [*keys, STRETCH], "left").select(
        *given, *[F.coalesce(f"__f_{n}", n).alias(n) for n in extremes])


def numbered(
    df: DataFrame, keys: Sequence[str], pos: str, name: str, start: int = 0, bits: Cutting = None
) -> DataFrame:
    """Dense row number within a key, in ``pos`` order."""
    counted = running(df, keys, pos, {name: Run("sum", F.lit(1).cast("bigint"))}, bits)
    return counted.withColumn(name, F.col(name) - 1 + start)


def looking_ahead(
    df: DataFrame, keys: Sequence[str], pos: str, value: Column, depth: int, name: str,
    bits: Cutting = None,
) -> DataFrame:
    """Array of ``value`` on the next ``depth`` rows of the key (shorter at the end).

    The first rows of a stretch are also sent to the stretch before, so each
    window still sees at most ``2**bits + depth`` rows.
    """
    keys = list(keys)
    given = df.columns
    bits = chosen(df, keys, bits)
    if not bits:
        frame = Window.partitionBy(*keys).orderBy(pos).rowsBetween(1, depth)
        seen = df.withColumn(name, F.collect_list(F.struct(value.alias("v"))).over(frame))
        return seen.withColumn(name, F.transform(name, lambda x: x["v"]))
    size = width(bits)
    if depth >= 1 << size:
        raise ValueError("depth must be smaller than a stretch")
    dense = numbered(df, keys, pos, "__rn", bits=bits)
    here = F.shiftright(F.col("__rn"), size)
    in_head = (F.col("__rn").bitwiseAND(F.lit((1 << size) - 1)) < depth) & (here > 0)
    copies = dense.withColumn("__v", F.struct(value.alias("v"))).withColumn(
        STRETCH, F.explode(F.when(in_head, F.array(here, here - 1)).otherwise(F.array(here)))
    )
    frame = Window.partitionBy(*keys, STRETCH).orderBy("__rn").rowsBetween(1, depth)
    seen = copies.withColumn(name, F.transform(F.collect_list("__v").over(frame), lambda x: x["v"]))
    return seen.filter(F.col(STRETCH) == here).select(*given, name)
