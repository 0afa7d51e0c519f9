"""Key lookups in which one key may hold a large share of the probing rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
HOT_KEYS = 100_000
SALTS = 64
BROADCAST_BYTES = 32 << 20


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; planning only, nothing runs."""
    plan = df._jdf.queryExecution().optimizedPlan()
    return int(str(plan.stats().sizeInBytes()))


def bounded(df: DataFrame) -> DataFrame:
    """Hint a broadcast only where the size estimate is small."""
    return F.broadcast(df) if estimated_bytes(df) <= BROADCAST_BYTES else df


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    row_id: Sequence[str],
    how: str = "left",
    broadcast_bytes: int | None = None,
    hot_rows: int | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Join ``left`` to ``right``, which has one row per key.

    A right side of checked small size is broadcast. Otherwise the keys that
    hold at least ``hot_rows`` left rows (the ``HOT_KEYS`` largest of them) are
    spread over ``salts`` partitions: left rows by a hash of ``row_id``, which
    must identify a row so that copies spread too, and right rows by
    replication. Rows with a NULL key match nothing and are spread by row id as
    well. All other keys join as they are; no row is left out.
    """
    on, row_id = list(on), list(row_id)
    broadcast_bytes = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    salts = SALTS if salts is None else salts
    if estimated_bytes(right) <= broadcast_bytes:
        return left.join(F.broadcast(right), on, how)

    hot = (
        left.groupBy(*on).count()
        .filter(F.col("count") >= hot_rows)
        .orderBy(F.desc("count"), *on)
        .limit(HOT_KEYS)
        .select(*on, F.lit(True).alias("__hot"))
    )
    salt = F.pmod(F.xxhash64(*row_id), F.lit(salts)).cast("int")
    loose = F.lit(False)
    for k in on:
        loose = loose | F.col(k).isNull()
    spread = left.join(F.broadcast(hot), on, "left").withColumn(
        "__salt", F.when(F.col("__hot") | loose, salt).otherwise(F.lit(0))
    ).drop("__hot")
    copies = right.join(F.broadcast(hot), on, "left").withColumn(
        "__salt",
        F.explode(
            F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
            .otherwise(F.array(F.lit(0)))
        ),
    ).drop("__hot")
    return spread.join(copies, [*on, "__salt"], how).drop("__salt")
