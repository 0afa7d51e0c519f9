"""Ordered concatenation into parts of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.operators.scan import Cutting, Run, running
from corpusprep.session import materialise

PART_CHARS = 4 << 20


def positioned(rows: DataFrame, order: Sequence[str], pos: str = "pos") -> DataFrame:
    """Give rows increasing positions in the given order, whatever values it has.

    Rows are ranged over the tasks and numbered inside each, so positions are dense
    within a task's rows. They are written, as a second run might range differently.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(placed.withColumn(pos, F.monotonically_increasing_id()), "positions")


def concat_ordered(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    text: str = "text",
    sep: str = "\n\n",
    part_chars: int = PART_CHARS,
    bits: Cutting = None,
) -> DataFrame:
    """Join the texts of a key in ``pos`` order: rows ``(*keys, part, n_blocks, text)``.

    A text longer than ``part_chars`` comes as several numbered parts, cut
    between blocks; the whole is ``sep.join(parts)``. So no task gathers more
    than one part, whatever the size of the key.
    """
    keys = list(keys)
    cost = F.greatest(F.length(text) + len(sep), F.lit(1)).cast("bigint")
    filled = running(
        df.select(*keys, pos, text), keys, pos, {"__before": Run("sum", cost, inclusive=False)}, bits
    )
    part = F.floor(F.coalesce("__before", F.lit(0)) / part_chars).cast("int")
    ordered = F.array_sort(F.collect_list(F.struct(F.col(pos), F.col(text).alias("t"))))
    return (
        filled.groupBy(*keys, part.alias("part"))
        .agg(ordered.alias("__t"))
        .select(
            *keys,
            "part",
            F.size("__t").alias("n_blocks"),
            F.array_join(F.transform("__t", lambda x: x["t"]), sep).alias("text"),
        )
    )
