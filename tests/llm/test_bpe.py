"""Words and ids against the tokenizers library, in large and in small blocks."""

import hashlib
import random

import corpora
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusprep.llm import bpe_codec, token_counts
from corpusprep.llm.bpe import encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_words_and_ids_on_random_texts(library):
    rng = random.Random(2)
    parts = ["a", "b", " ", "  ", "'s", "'", "\n", "\t", ".", "1", "é", "\xa0", "\u3000", "\x1c", "\0", "日",
             "<|endoftext|>", "'ll", "S", "\u200b", "\U0001f600"]
    bpe = encoder(PATH)
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        words = bpe.words(text)
        assert "".join(words) == text
        assert [int(i) for ids in bpe.encode(words) for i in ids] == ids_of(library, text)


def test_every_code_point_splits_as_in_the_library(library):
    bpe = encoder(PATH)
    points = [c for c in range(0x3100) if not 0xD800 <= c <= 0xDFFF]
    text = "".join(f"a{chr(c)} {chr(c)}b  {chr(c)}1\n" for c in points)
    assert [int(i) for ids in bpe.encode(bpe.words(text)) for i in ids] == ids_of(library, text)


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 4096}, {"block_words": 3}])
def test_codec(spark, library, sizes):
    docs = corpora.hard(spark)
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, ids_of(library, r["text"]), r["text"] or "") for r in docs.collect())
    ids = bpe_codec.encode(docs, PATH, **sizes)
    done = bpe_codec.decode(ids, bpe_codec.piece_table(spark, PATH)).collect()
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, np.frombuffer(bytes(r["ids"]), "<u4").tolist(),
                  bytes(r["decoded"]).decode()) for r in done)
    assert got == want
    both = bpe_codec.round_trip(docs, PATH, **sizes).collect()
    assert sorted(map(str, both)) == sorted(map(str, done))


def test_codec_of_nothing(spark):
    ids = bpe_codec.encode(corpora.empty(spark), PATH)
    assert bpe_codec.decode(ids, bpe_codec.piece_table(spark, PATH)).collect() == []
    assert bpe_codec.round_trip(corpora.empty(spark), PATH).collect() == []


def test_broken_bytes_decode_to_replacement_signs(spark, library):
    pieces = encoder(PATH).pieces
    lone = [i for i, p in enumerate(pieces) if p in (b"\xc3", b"\xe2")]
    rows = spark.createDataFrame([(1, np.array(lone, "<u4").tobytes())], "doc_id long, ids binary")
    got = bpe_codec.decode(rows, bpe_codec.piece_table(spark, PATH)).first()["decoded"]
    assert bytes(got).decode() == library.decode(lone, skip_special_tokens=False)


def test_token_counts_and_cache(spark, library, tmp_path):
    docs, cache = corpora.hard(spark), str(tmp_path / "cache")
    for _ in range(2):
        got = token_counts.token_counts(docs, PATH, cache).collect()
        want = [(r["doc_id"], len((r["text"] or "").encode()), len(ids_of(library, r["text"]))) for r in docs.collect()]
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
        # Each distinct text is stored once; the second run finds all of them.
        stored = spark.read.parquet(cache)
        assert stored.count() == len({r["text"] or "" for r in docs.collect()})
    digests = {bytes(r["digest"]) for r in spark.read.parquet(cache).collect()}
    assert hashlib.sha256(b"a").digest() in digests
    assert token_counts.token_counts(corpora.empty(spark), PATH, cache).collect() == []


def test_stored_counts_are_used(spark, tmp_path):
    docs, cache = corpora.table(spark, ["one two"]), str(tmp_path / "cache")
    version = encoder(PATH).version
    spark.createDataFrame(
        [(hashlib.sha256(b"one two").digest(), version, 99), (hashlib.sha256(b"one two").digest(), "other", 5)],
        token_counts.CACHE).write.parquet(cache)
    assert token_counts.token_counts(docs, PATH, cache).first()["n_tokens"] == 99
