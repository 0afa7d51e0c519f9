"""Texts as numbers of words, block by block.

Each task splits its texts once, in the order they come, and numbers the distinct words of a
block of bounded text size and vocabulary, frequent words first. What a block holds is packed and
written, block by block: its documents as numbers, and its words, dealt into buckets by a hash of the
word. A text is split no second time, and documents do not move.

What is to be known about words, whatever their number, is found out bucket by bucket: there all
blocks' rows of a word meet, one per block. The answers go back to the blocks, packed, and meet the
documents there. So what moves are few rows of packed arrays; nothing about the whole vocabulary is
collected or broadcast, and the way is the same at every size. Copies of a text are spread like any
others.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence
from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import SLICE_BYTES, Rows, slices, spans_of, texts
from corpusprep.operators.lookup import estimated_bytes
from corpusprep.session import shared_dir

BLOCK_BYTES = 24 << 20
BLOCK_WORDS = 400_000
BUCKET_BYTES = 12 << 20
MOST_BUCKETS = 8192
UNKNOWN_BYTES = 1 << 60
ROW_BYTES = 64

Split = Callable[[bytes], list]


def pack(values: np.ndarray) -> bytes:
    """Numbers from 0 on, byte plane by byte plane, compressed; small numbers take little room."""
    if not len(values):
        return b""
    planes = max(1, (int(values.max()).bit_length() + 7) // 8)
    raw = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T[:planes])
    return bytes([planes]) + zstandard.ZstdCompressor(level=1).compress(raw.tobytes())


def unpack(blob: bytes | None) -> np.ndarray:
    if not blob:
        return np.empty(0, np.int64)
    planes = blob[0]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.uint8).reshape(planes, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :planes] = raw.T
    return out.view("<i8").ravel()


def pack_words(words: list[bytes]) -> bytes:
    """Words end to end and their lengths, compressed."""
    lengths = pack(np.fromiter(map(len, words), np.int64, len(words)))
    return len(lengths).to_bytes(8, "little") + lengths + zstandard.ZstdCompressor(level=1).compress(b"".join(words))


def unpack_words(blob: bytes) -> list[bytes]:
    stop = 8 + int.from_bytes(blob[:8], "little")
    ends = np.cumsum(unpack(blob[8:stop])).tolist()
    whole = zstandard.ZstdDecompressor().decompress(blob[stop:])
    return [whole[a:b] for a, b in zip([0, *ends], ends)]


class Block:
    """Words, documents as numbers and, for texts to learn from, counts of words and of neighbours."""

    def __init__(self):
        # A word gets the next number when it is first asked for.
        self.index: dict = defaultdict(count().__next__)
        self.filled = 0
        self.pieces: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]] = []
        self.learned: list[tuple[np.ndarray, np.ndarray]] = []

    def number(self, lists: list[list]) -> np.ndarray:
        total = sum(map(len, lists))
        return np.fromiter(map(self.index.__getitem__, chain.from_iterable(lists)), np.uint32, total)

    def by_frequency(self) -> list:
        """Number the words anew, frequent ones first; the words in order."""
        counts = np.zeros(len(self.index), np.int64)
        for _, ids, _ in self.pieces:
            counts += np.bincount(ids, minlength=len(counts))
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        self.pieces = [(piece, rank[ids], offsets) for piece, ids, offsets in self.pieces]
        self.learned = [(rank[ids], offsets) for ids, offsets in self.learned]
        words = list(self.index)
        return [words[i] for i in order.tolist()]

    def counts(self) -> np.ndarray:
        out = np.zeros(len(self.index), np.int64)
        for ids, _ in self.learned:
            out += np.bincount(ids, minlength=len(out))
        return out

    def pairs(self) -> list[bytes]:
        """Neighbours and their counts; a text's last word precedes its first.

        Packed: how many words come after each word, these words, and how often they do.
        """
        keys = [np.empty(0, np.int64)]
        for ids, offsets in self.learned:
            before = np.roll(ids, 1)
            some = offsets[1:] > offsets[:-1]
            before[offsets[:-1][some]] = ids[offsets[1:][some] - 1]
            keys.append(before.astype(np.int64) << 32 | ids)
        pair, n = np.unique(np.concatenate(keys), return_counts=True)
        return [pack(np.bincount(pair >> 32, minlength=len(self.index))), pack(pair & 0xFFFFFFFF), pack(n)]


def neighbours(rows: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(before, after, n)`` of a block's packed neighbours."""
    parts = [[unpack(b) for b in row] for row in rows]
    before = [np.repeat(np.arange(len(sizes)), sizes) for sizes, *_ in parts]
    join = lambda arrays: np.concatenate([np.empty(0, np.int64), *arrays])
    return join(before), join([p[1] for p in parts]), join([p[2] for p in parts])


def placed(rows: DataFrame, by: str, n: int, name: str) -> DataFrame:
    """The rows, written to the shared folder in ``n`` files by a hash of ``by``; grouping by it moves no rows.

    The table's name is only needed to write it, and goes at once.
    """
    spark = rows.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    rows.write.format("parquet").option("path", shared_dir(spark, name)).bucketBy(n, by).saveAsTable(table)
    try:
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")


def buckets_for(docs: DataFrame) -> int:
    """As many buckets of words as the size of the texts asks for; where Spark cannot tell it, it is counted."""
    size = estimated_bytes(docs)
    if size >= UNKNOWN_BYTES:
        size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return int(min(MOST_BUCKETS, 2 + size // BUCKET_BYTES))


def numbered(
    docs: DataFrame, split: Split, keep: Sequence[str] = (), learn: str | None = None, buckets: int | None = None,
    block_bytes: int | None = None, block_words: int | None = None,
) -> DataFrame:
    """The documents, words and neighbours of blocks, written as one table.

    ``docs`` has the text as bytes in ``text``. Rows with ``ids`` are documents, some per row: ``ids`` are
    the numbers of their words end to end, ``sizes`` how many each has, and the columns to ``keep`` are
    arrays. Rows with ``words`` are the words of a block in a bucket, sorted, with their ``numbers`` and, in
    ``n``, their counts in the texts whose column ``learn`` is true. Rows with ``pair`` are the
    neighbours in those texts.
    """
    most, widest = block_bytes or BLOCK_BYTES, block_words or BLOCK_WORDS
    n_buckets = buckets or buckets_for(docs)
    kept = [docs.schema[k] for k in keep]
    schema = ", ".join([
        "block long", *[f"`{f.name}` array<{f.dataType.simpleString()}>" for f in kept],
        "sizes binary", "ids binary", "bucket int", "words binary", "numbers binary", "n binary", "pair array<binary>"])
    others = {"sizes": pa.binary(), "ids": pa.binary(), "bucket": pa.int32(), "words": pa.binary(),
              "numbers": pa.binary(), "n": pa.binary(), "pair": pa.list_(pa.binary())}
    names = ["block", *keep, *others]

    def run(batches: Rows) -> Rows:
        from pyspark import TaskContext

        number, block = TaskContext.get().partitionId() << 32, Block()
        types: list = []

        def row(**given) -> pa.RecordBatch:
            columns = [pa.array([number], pa.int64())]
            columns += [given.get(k, pa.nulls(1, pa.list_(t))) for k, t in zip(keep, types)]
            columns += [pa.array([given.get(k)], t) for k, t in others.items()]
            return pa.record_batch(columns, names)

        def closed() -> Rows:
            words = [w.encode() if isinstance(w, str) else w for w in block.by_frequency()]
            for piece, ids, offsets in block.pieces:
                lists = {k: pa.ListArray.from_arrays(pa.array([0, piece.num_rows], pa.int32()), piece.column(k)) for k in keep}
                yield row(sizes=pack(np.diff(offsets)), ids=pack(ids), **lists)
            n = block.counts()
            place = np.fromiter((xxhash.xxh64_intdigest(w) % n_buckets for w in words), np.int64, len(words))
            order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
            order = order[np.argsort(place[order], kind="stable")]
            there, first = np.unique(place[order], return_index=True)
            for at, some in zip(there.tolist(), np.split(order, first[1:]) if len(there) else []):
                yield row(bucket=at, words=pack_words([words[i] for i in some.tolist()]), numbers=pack(some), n=pack(n[some]))
            if block.learned:
                yield row(pair=block.pairs())

        for batch in batches:
            types = [batch.schema.field(k).type for k in keep]
            for piece in slices(batch, "text", min(SLICE_BYTES, most)):
                held = texts(piece)
                lists = [split(t) for t in held]
                ids = block.number(lists)
                offsets = spans_of(list(map(len, lists)))
                block.pieces.append((piece.select(list(keep)), ids, offsets))
                if learn is not None:
                    told = np.array(piece.column(learn).to_pylist(), bool)
                    each = np.repeat(told, np.diff(offsets))
                    block.learned.append((ids[each], spans_of(np.diff(offsets)[told])))
                block.filled += sum(map(len, held)) + ROW_BYTES * len(held)
                if block.filled > most or len(block.index) > widest:
                    yield from closed()
                    number, block = number + 1, Block()
        if block.pieces:
            yield from closed()

    columns = list(dict.fromkeys([*keep, *([learn] if learn else []), "text"]))
    return placed(docs.select(*columns).mapInArrow(run, schema), "block", n_buckets, "blocks")


def documents_of(blocks: DataFrame, *keep: str) -> DataFrame:
    return blocks.filter(F.col("sizes").isNotNull()).select("block", *keep, "sizes", "ids")


def words_of(blocks: DataFrame) -> DataFrame:
    """``(bucket, block, words, numbers, n)``: the words of every block, packed."""
    return blocks.filter(F.col("words").isNotNull()).select("bucket", "block", "words", "numbers", "n")


def pairs_of(blocks: DataFrame) -> DataFrame:
    return blocks.filter(F.col("pair").isNotNull()).select("block", "pair")


def pieces_of(left: pa.Table, keep: Sequence[str]):
    """The documents of a block, some at a time: columns to keep, numbers end to end, and offsets."""
    for batch in left.combine_chunks().to_batches():
        for i in range(batch.num_rows):
            columns = [batch.column(k).slice(i, 1).flatten() for k in keep]
            offsets = spans_of(unpack(batch.column("sizes")[i].as_py()))
            yield columns, unpack(batch.column("ids")[i].as_py()), offsets


Meet = Callable[[pa.Table, pa.Table], pa.Table]


def meet(left: DataFrame, right: DataFrame, on: str, fn: Meet, schema: str) -> DataFrame:
    """``fn`` of the rows of both sides for a block or a bucket."""
    # Both sides may come from one table, whose columns would be the same.
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    return left.groupBy(on).cogroup(right.groupBy(on)).applyInArrow(fn, schema)


def by_number(known: pa.Table, column: str, size: int, missing: int) -> np.ndarray:
    """What is known about the words of a block, packed, in an array by number."""
    out = np.full(size, missing, np.int64)
    for numbers, values in zip(known.column("numbers").to_pylist(), known.column(column).to_pylist()):
        out[unpack(numbers)] = unpack(values)
    return out


def width(known: pa.Table, *arrays: np.ndarray) -> int:
    """How many numbers a block has at least."""
    most = [unpack(n).max(initial=-1) for n in known.column("numbers").to_pylist()]
    return 1 + int(max([-1, *most, *(a.max(initial=0) for a in arrays)]))
