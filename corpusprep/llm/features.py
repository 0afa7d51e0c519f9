"""Hashed n-gram features of byte texts, computed for a slice of texts at once."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np

from corpusprep.llm.common import spans_of

# A-Z in lower case, ASCII white space as blanks, digits as one sign.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9:14] = 32
_FOLD[48:58] = 48


def joined(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts folded, with a blank at both ends, end to end; and their offsets."""
    data = np.frombuffer(b"".join(b" " + t + b" " for t in texts), np.uint8)
    return _FOLD[data], spans_of([len(t) + 2 for t in texts])


def char_ids(data: np.ndarray, offsets: np.ndarray, n: int, buckets: int) -> np.ndarray:
    """Bucket of the ``n`` bytes from each position on; ``buckets`` itself where a text ends before."""
    ids = np.full(len(data), buckets, np.int32)
    if len(data) >= n:
        key = data[:len(data) - n + 1].astype(np.uint64)
        for k in range(1, n):
            key |= data[k:len(data) - n + 1 + k].astype(np.uint64) << np.uint64(8 * k)
        key = (key + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        ids[:len(key)] = ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
    for k in range(1, n):
        at = offsets[1:] - k
        ids[at[at >= offsets[:-1]]] = buckets
    return ids


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def word_ids(hashes: np.ndarray, n: int, buckets: int) -> np.ndarray:
    """Bucket of the ``n`` words from each word on, within one text."""
    if len(hashes) < n:
        return np.empty(0, np.int32)
    key = hashes[:len(hashes) - n + 1].copy()
    for k in range(1, n):
        key = key * np.uint64(0x100000001B3) + hashes[k:len(hashes) - n + 1 + k]
    key = (key + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
    return ((key >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each run of ``values``; 0 for empty runs."""
    upto = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


class Sparse:
    """Rows of shares: ``x[row, column] = count / rows's total`` in each block of columns."""

    def __init__(self, rows: Sequence[tuple[np.ndarray, np.ndarray]]):
        self.n = len(rows)
        self.index = np.concatenate([np.empty(0, np.int64), *(r[0] for r in rows)]).astype(np.int64)
        self.value = np.concatenate([np.empty(0), *(r[1] for r in rows)])
        self.row = np.repeat(np.arange(self.n), [len(r[0]) for r in rows])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.index], self.n)

    def transposed_dot(self, r: np.ndarray, columns: int) -> np.ndarray:
        return np.bincount(self.index, self.value * r[self.row], columns)

    def scaled(self, columns: int) -> np.ndarray:
        """Scales every column by the root of its root mean square, so that frequent columns
        stay ahead of rare ones; returns the factors."""
        square = np.bincount(self.index, self.value ** 2, columns) / max(self.n, 1)
        factor = 1 / (square ** 0.25 + 1e-3)
        self.value = self.value * factor[self.index]
        return factor


def shares(ids: Sequence[np.ndarray], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Non-zero columns and shares of one text; block ``k`` has ``ids[k]``."""
    index, value = [], []
    for k, block in enumerate(ids):
        block = block[block < buckets]
        if len(block):
            found, count = np.unique(block, return_counts=True)
            index.append(found.astype(np.int64) + k * buckets)
            value.append(count / len(block))
    return np.concatenate([np.empty(0, np.int64), *index]), np.concatenate([np.empty(0), *value])


def pack(row: tuple[np.ndarray, np.ndarray]) -> bytes:
    return row[0].astype("<i4").tobytes() + row[1].astype("<f4").tobytes()


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 8
    return np.frombuffer(data, "<i4", n), np.frombuffer(data, "<f4", n, 4 * n).astype(np.float64)
