"""Helpers the training-data operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 4 << 20

Rows = Iterator[pa.RecordBatch]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def remainder(doc_id: Column, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``; NULL for a NULL id."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(modulus))


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Rows:
    """Cut a batch so that each piece holds about ``limit`` text bytes, or one row."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    upto = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < len(upto):
        floor = upto[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, floor + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def map_slices(
    rows: DataFrame, text: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """``fn`` over Arrow slices of bounded text size."""

    def run(batches: Rows) -> Rows:
        for batch in batches:
            for piece in slices(batch, text, limit):
                yield fn(piece)

    return rows.mapInArrow(run, schema)


def texts(piece: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a slice as UTF-8; NULL is the empty text."""
    return [t or b"" for t in piece.column(column).to_pylist()]


def as_bytes(docs: DataFrame, *keep: str | Column, text: str = "text") -> DataFrame:
    """The named columns and the text as UTF-8 bytes."""
    return docs.select(*keep, F.col(text).cast("binary").alias("text"))


def gather(flat: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries ``index`` of a ragged array end to end, and the length of each."""
    starts = offsets[index].astype(np.int64)
    sizes = offsets[index + 1].astype(np.int64) - starts
    before = np.cumsum(sizes) - sizes
    at = np.repeat(starts - before, sizes)
    at += np.arange(len(at))
    return flat[at], sizes


def spans_of(counts: Sequence[int]) -> np.ndarray:
    """Offsets of consecutive runs with the given lengths."""
    return np.concatenate([[0], np.cumsum(np.asarray(counts, dtype=np.int64))])


@contextmanager
def short_lived_shuffles(spark):
    """Shuffle files go once a written table is complete; nothing reads them afterwards."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
