"""BPE encoding through a table of distinct words, and decoding through a table of pieces.

Texts are split once, into numbered words of blocks. The words of all blocks meet in Spark, bucket
by bucket, and each distinct word is encoded once; its ids go back to the blocks that have it, where
they take the words' places. Decoding joins ids to the vocabulary's pieces by position; the table of
pieces is bounded by the vocabulary. Words are told apart as such, not by a hash.

Cases: a NULL text is the empty one and gives no ids; repeated rows give repeated results;
an empty table gives an empty result; special strings inside a text become their ids, as
the tokenizer's default has it; bytes that form no text decode to U+FFFD; a text longer than a
block is a block of its own; other columns of the input are dropped, so their names cannot
clash; no result depends on the order of rows, so there are no ties.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm.blocks import (
    documents_of, meet, numbered, pack, pieces_of, unpack, unpack_words, width, words_of)
from corpusprep.llm.bpe import encoder
from corpusprep.llm.common import as_bytes, gather, map_slices, spans_of


DECODE_IDS = 1 << 17


def encoded_words(words: DataFrame, tokenizer: str) -> DataFrame:
    """``(block, numbers, sizes, ids)``: the words of blocks, each distinct word encoded once.

    A word is in one bucket, where all blocks' rows of it meet.
    """

    def encode(table: pa.Table) -> pa.Table:
        bpe = encoder(tokenizer)
        lists = [unpack_words(w) for w in table.column("words").to_pylist()]
        place = {w: i for i, w in enumerate(sorted(set().union(*lists)))}
        coded = bpe.encode([w.decode() for w in place])
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        flat, starts = np.concatenate([np.empty(0, np.uint32), *coded]), spans_of(sizes)
        out_sizes, out_ids = [], []
        for held in lists:
            at = np.fromiter(map(place.__getitem__, held), np.int64, len(held))
            ids, n = gather(flat, starts, at)
            out_sizes.append(pack(n))
            out_ids.append(pack(ids))
        return pa.table({"block": table.column("block"), "numbers": table.column("numbers"),
                         "sizes": pa.array(out_sizes, pa.binary()), "ids": pa.array(out_ids, pa.binary())})

    return words.select("bucket", "block", "words", "numbers").groupBy("bucket").applyInArrow(
        encode, "block long, numbers binary, sizes binary, ids binary")


def encode(
    docs: DataFrame, tokenizer: str, doc: str = "doc_id", text: str = "text", pieces: DataFrame | None = None, **sizes: int,
) -> DataFrame:
    """``(doc, ids)``: the ids as little-endian unsigned 32-bit numbers.

    With a table of ``pieces`` they are decoded in the same pass, by the join of ``decode``: ``(doc, ids, decoded)``.
    """
    shared = None if pieces is None else _shared(pieces)
    kind = docs.schema[doc].dataType.simpleString()
    rows = as_bytes(docs, F.col(doc).alias("doc"), text=text)
    held = numbered(rows, lambda t: encoder(tokenizer).words(t.decode()), ["doc"], **sizes)

    def joined(left: pa.Table, words: pa.Table) -> pa.Table:
        numbers, lengths, coded = ([unpack(v) for v in words.column(c).to_pylist()] for c in ("numbers", "sizes", "ids"))
        join = lambda parts: np.concatenate([np.empty(0, np.int64), *parts])
        starts, flat = spans_of(join(lengths)), join(coded)
        # Where the word with a number is among those that came back.
        at = np.zeros(width(words), np.int64)
        at[join(numbers)] = np.arange(len(starts) - 1)
        out = []
        for (docs_,), entries, offsets in pieces_of(left, ["doc"]):
            ids, n = gather(flat, starts, at[entries])
            ends, wide = spans_of(n)[offsets], ids.astype("<u4")
            spans = [wide[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
            columns = {doc: docs_, "ids": pa.array(spans, pa.binary())}
            if shared is not None:
                columns["decoded"] = pa.array(_texts_of(ids, ends, *shared.value), pa.binary())
            out.append(pa.record_batch(list(columns.values()), list(columns)))
        names = ["ids"] + ["decoded"] * (shared is not None)
        empty = pa.schema([(doc, left.schema.field("doc").type.value_type), *((n, pa.binary()) for n in names)])
        return pa.Table.from_batches(out, out[0].schema if out else empty)

    return meet(documents_of(held, "doc"), encoded_words(words_of(held), tokenizer), "block", joined,
                f"`{doc}` {kind}, ids binary" + ", decoded binary" * (shared is not None))


def _texts_of(ids: np.ndarray, ends: np.ndarray, flat: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The pieces of ``ids[ends[i]:ends[i + 1]]`` end to end, as valid UTF-8; a bounded number of ids at a time, or one text."""
    out: list[bytes] = []
    start = 0
    while start < len(ends) - 1:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + DECODE_IDS, side="right")) - 1)
        out += _some_texts(ids[ends[start]:ends[stop]], ends[start:stop + 1] - ends[start], flat, offsets)
        start = stop
    return out


def _some_texts(ids: np.ndarray, ends: np.ndarray, flat: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The pieces of ``ids[ends[i]:ends[i + 1]]`` end to end, as valid UTF-8."""
    shown, sizes = gather(flat, offsets, ids.astype(np.int64))
    cuts = spans_of(sizes)[ends]
    whole = shown.tobytes()
    out = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        part = whole[a:b]
        try:
            part.decode()
        except UnicodeDecodeError:
            part = part.decode("utf-8", "replace").encode()
        out.append(part)
    return out


def piece_table(spark: SparkSession, tokenizer: str) -> DataFrame:
    """``(id, piece)`` of a vocabulary."""
    pieces = encoder(tokenizer).pieces
    return spark.createDataFrame(
        pa.table({"id": pa.array(range(len(pieces)), pa.int64()), "piece": pa.array(pieces, pa.binary())}))


def _shared(pieces: DataFrame):
    """A table of pieces as broadcast arrays by id: all pieces end to end, and where each begins."""
    table = pieces.orderBy("id").toArrow()
    if table.column("id").to_pylist() != list(range(table.num_rows)):
        raise ValueError("piece ids must be dense")
    words = table.column("piece").to_pylist()
    return pieces.sparkSession.sparkContext.broadcast(
        (np.frombuffer(b"".join(words), np.uint8), spans_of(list(map(len, words)))))


def decode(tokens: DataFrame, pieces: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``(doc, ids, decoded)``: ids joined to their pieces by position; UTF-8 bytes."""
    kind = tokens.schema[doc].dataType.simpleString()
    shared = _shared(pieces)

    def joined(piece: pa.RecordBatch) -> pa.RecordBatch:
        flat, offsets = shared.value
        rows = [np.frombuffer(i or b"", "<u4") for i in piece.column("ids").to_pylist()]
        every = np.concatenate([*rows, np.empty(0, "<u4")])
        values = _texts_of(every, spans_of(list(map(len, rows))), flat, offsets)
        return pa.record_batch(
            [piece.column(0), piece.column("ids"), pa.array(values, pa.binary())], [doc, "ids", "decoded"])

    return map_slices(
        tokens.select(doc, "ids"), "ids", joined, f"`{doc}` {kind}, ids binary, decoded binary")


def round_trip(docs: DataFrame, tokenizer: str, doc: str = "doc_id", text: str = "text", **sizes: int) -> DataFrame:
    """``(doc, ids, decoded)``: the ids of every text, and what they decode to."""
    return encode(docs, tokenizer, doc, text, piece_table(docs.sparkSession, tokenizer), **sizes)
