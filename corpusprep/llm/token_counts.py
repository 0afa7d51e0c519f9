"""Token counts through a digest cache.

The cache is a table ``(digest, version, n_tokens)``: the SHA-256 of a text and of
the tokenizer's file. Texts are made distinct by digest before anything is encoded,
so a group of copies costs one encoding; only digests the cache lacks are encoded,
and the new counts are appended. Within a batch each distinct word is encoded once.

Cases: a NULL text counts as the empty one (no tokens, no bytes); repeated rows give
repeated results; an empty table gives an empty result; columns of the input other
than the named ones are dropped, so their names cannot clash. A text is encoded whole,
however long, with memory in proportion to it; no result depends on the order of rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm.bpe import encoder
from corpusprep.llm.common import map_slices, texts

CACHE = "digest binary, version string, n_tokens long"
KNOWN_WORDS = 500_000


def content_digest(text: str = "text"):
    """SHA-256 of the normalised content: NULL becomes the empty text, nothing else changes."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def empty_cache(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], CACHE).write.mode("ignore").parquet(path)


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """Counts of one tokenizer version, one row per digest even if two jobs appended the same."""
    rows = spark.read.schema(CACHE).parquet(path).filter(F.col("version") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def encode_counts(rows: DataFrame, tokenizer: str) -> DataFrame:
    """``(digest, n_tokens)`` of ``(digest, text as bytes)``."""
    known: dict[str, int] = {}

    def count(piece: pa.RecordBatch) -> pa.RecordBatch:
        bpe = encoder(tokenizer)
        split = [bpe.words(t.decode()) for t in texts(piece)]
        fresh = list({w for s in split for w in s} - known.keys())
        if len(known) + len(fresh) > KNOWN_WORDS:
            known.clear()
            fresh = list({w for s in split for w in s})
        known.update(zip(fresh, map(len, bpe.encode(fresh))))
        totals = [sum(map(known.__getitem__, s)) for s in split]
        return pa.record_batch(
            [piece.column("digest"), pa.array(totals, pa.int64())], ["digest", "n_tokens"])

    return map_slices(rows, "text", count, "digest binary, n_tokens long")


def token_counts(
    docs: DataFrame, tokenizer: str, cache: str, doc: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(doc, n_bytes, n_tokens)`` of every row; misses are encoded and appended to the cache."""
    spark = docs.sparkSession
    version = encoder(tokenizer).version
    empty_cache(spark, cache)
    keyed = docs.select(
        F.col(doc).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("digest", content_digest())
    misses = (
        keyed.select("digest", F.col("text").cast("binary").alias("text"))
        .join(read_cache(spark, cache, version), "digest", "left_anti")
        .groupBy("digest").agg(F.first("text").alias("text"))
    )
    counted = encode_counts(misses, tokenizer).withColumn("version", F.lit(version))
    counted.select("digest", "version", "n_tokens").write.mode("append").parquet(cache)
    sizes = keyed.select("doc_id", "digest", F.octet_length("text").cast("bigint").alias("n_bytes"))
    return sizes.join(read_cache(spark, cache, version), "digest").select(
        F.col("doc_id").alias(doc), "n_bytes", "n_tokens")
