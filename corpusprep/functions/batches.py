"""Arrow batches in pieces of bounded size: a batch is bounded in rows, but its texts may have any length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20


def cuts(texts: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Where the pieces of an array of texts begin and end; past its first text, a piece has at most ``most`` bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    bounds = [0, *(np.flatnonzero(np.diff(ends // most)) + 1).tolist(), len(texts)]
    return zip(bounds, bounds[1:])


def pieces(texts: pa.Array, most: int = PIECE_BYTES) -> Iterator[pa.Array]:
    return (texts.slice(a, b - a) for a, b in cuts(texts, most))
