"""Order-dependent folds over a giant key, without giving the key to one task.

The fold's state is one integer. For each stretch of a key, a *transfer table*
says how every possible entering state leaves it: rows ``(lo, hi, base, slope,
emitted)`` mean that a state ``c`` in ``[lo, hi]`` leaves as ``base + slope * c``
after emitting that many outputs. The tables are small, so a streaming pass over
them in key order yields the state at which each stretch is entered; then all
stretches are folded independently.

Rows reach Python sorted by ``(keys, stretch, pos)`` within partitions hashed on
``(keys, stretch)``, so a partition holds whole stretches and is read as a stream.
``mapInPandas`` demands no partitioning of its own: a plain ``repartition(keys)``
over a join on the same keys is dropped as redundant, and the adaptive join may then
scatter the keys. So rows are hashed on a hash of the keys, which is never redundant.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.operators.scan import STRETCH, Cutting, chosen, in_stretches
from corpusprep.session import settled

Transfer = Callable[[np.ndarray], list[tuple[int, int, int, int, int]]]
Apply = Callable[[np.ndarray, int, int], np.ndarray]
UNBOUNDED = 1 << 40
WHOLE_KEY = -(1 << 62)
SLICE_ROWS = 50_000


def groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of whole groups of consecutive equal keys, across batch borders."""
    held: dict[str, np.ndarray] = {}
    for frame in batches:
        batch = {name: frame[name].to_numpy() for name in frame.columns}
        if held:
            batch = {name: np.concatenate([held[name], batch[name]]) for name in batch}
        rows = len(batch[keys[0]])
        if not rows:
            continue
        new = np.zeros(rows, dtype=bool)
        new[0] = True
        for k in keys:
            new[1:] |= batch[k][1:] != batch[k][:-1]
        cuts = np.flatnonzero(new)
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield {name: values[a:b] for name, values in batch.items()}
        held = {name: values[cuts[-1]:] for name, values in batch.items()}
    if held:
        yield held


def stateful_fold(
    rows: DataFrame, keys: Sequence[str], pos: str, value: str, initial: int,
    transfer: Transfer, apply: Apply, result: str, bits: Cutting = None,
) -> DataFrame:
    """Fold ``value`` along ``pos``: ``(*keys, pos, result)``.

    ``apply(values, state, emitted)`` gives one integer per row of a stretch
    that is entered in ``state`` after ``emitted`` outputs.
    """
    keys = list(keys)
    whole = [*keys, STRETCH]
    bits = chosen(rows, keys, bits)
    if not bits:
        return _folded_whole(rows, keys, pos, value, initial, apply, result)
    rows = settled(rows)
    slim = in_stretches(rows.select(*keys, pos, value), pos, bits)
    placed = together(slim.filter(F.col(STRETCH).isNotNull()), whole, pos)
    key_fields = [rows.schema[k] for k in keys]
    long = T.LongType()

    table_type = T.StructType([
        *key_fields, T.StructField(STRETCH, long),
        *[T.StructField(n, long) for n in ("lo", "hi", "base", "slope", "emitted")],
    ])

    def tables(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for g in groups(batches, whole):
            first = tuple(g[k][0] for k in whole)
            out += [first + row for row in transfer(g[value])]
            if len(out) > SLICE_ROWS:
                yield pd.DataFrame(out, columns=table_type.names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=table_type.names)

    entry_type = T.StructType([
        *key_fields, T.StructField(STRETCH, long),
        T.StructField("__state", long), T.StructField("__emitted", long),
    ])

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, emitted, out = None, initial, 0, []
        for g in groups(batches, whole):
            here = tuple(g[k][0] for k in keys)
            if here != key:
                key, state, emitted = here, initial, 0
            out.append((*here, g[STRETCH][0], state, emitted))
            at = np.flatnonzero((g["lo"] <= state) & (g["hi"] >= state))[0]
            state = int(g["base"][at] + g["slope"][at] * state)
            emitted += int(g["emitted"][at])
            if len(out) > SLICE_ROWS:
                yield pd.DataFrame(out, columns=entry_type.names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=entry_type.names)

    summaries = placed.mapInPandas(tables, table_type)
    entered = together(summaries, keys, STRETCH, "lo").mapInPandas(entries, entry_type)
    result_type = T.StructType([
        *key_fields, rows.schema[pos], T.StructField(result, long),
    ])

    def results(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for g in groups(batches, whole):
            skip, state, emitted = 0, initial, 0
            if g["__entry"][0]:
                skip, state, emitted = 1, int(g[value][0]), int(g["__emitted"][0])
            got = apply(g[value][skip:], state, emitted)
            held.append([*(g[k][skip:] for k in keys), g[pos][skip:], got])
            size += len(got)
            if size > SLICE_ROWS:
                yield _packed(held, result_type.names)
                held, size = [], 0
        if held:
            yield _packed(held, result_type.names)

    # The entering state travels as a row in front of its stretch, so no join is needed.
    first = entered.select(
        *whole, F.lit(0).cast(rows.schema[pos].dataType).alias(pos), F.col("__state").alias(value),
        "__emitted", F.lit(True).alias("__entry"))
    body = slim.select(
        *keys, F.coalesce(STRETCH, F.lit(WHOLE_KEY)).alias(STRETCH), pos, F.col(value).cast("bigint").alias(value), F.lit(0).cast("bigint").alias("__emitted"),
        F.lit(False).alias("__entry"))
    stream = together(body.unionByName(first), whole, F.desc("__entry"), pos)
    return stream.mapInPandas(results, result_type)


def together(df: DataFrame, keys: Sequence[str], *order: str | Column) -> DataFrame:
    """Rows of a key in one partition, one after the other, in ``order``."""
    return df.repartition(F.xxhash64(*keys)).sortWithinPartitions(*keys, *order)


def _folded_whole(
    rows: DataFrame, keys: list[str], pos: str, value: str, initial: int, apply: Apply, result: str
) -> DataFrame:
    """The fold where no key is hot: each key in one piece, results in slices."""
    schema = T.StructType([
        *[rows.schema[k] for k in keys], rows.schema[pos], T.StructField(result, T.LongType())])

    def results(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for g in groups(batches, keys):
            held.append([*(g[k] for k in keys), g[pos], apply(g[value], initial, 0)])
            size += len(g[value])
            if size > SLICE_ROWS:
                yield _packed(held, schema.names)
                held, size = [], 0
        if held:
            yield _packed(held, schema.names)

    return together(rows.select(*keys, pos, value), keys, pos).mapInPandas(results, schema)


def _packed(held: list[list[np.ndarray]], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame({n: np.concatenate([h[i] for h in held]) for i, n in enumerate(names)})
