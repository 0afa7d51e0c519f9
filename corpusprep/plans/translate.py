"""From source documents to translated ones, and a report of what is left to do."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.operators.cache import translate
from corpusprep.operators.concat import concat_ordered
from corpusprep.operators.packing import CHUNK_CHARS, chunk_text
from corpusprep.operators.rules import glossary_rewrite
from corpusprep.operators.spans import SpanKind, mask_spans, unmask
from corpusprep.session import materialise


def rewrite_protected(
    docs: DataFrame, kinds: Sequence[SpanKind], words: Mapping[str, str],
    phrases: Mapping[str, str] | None = None, text: str = "text", out: str = "restored",
) -> DataFrame:
    """Mask, apply the glossary to the rest, and put the spans back; all within the row."""
    masked = mask_spans(docs, kinds, text)
    return unmask(glossary_rewrite(masked, words, phrases, "masked"), kinds, out=out)


def translate_documents(
    docs: DataFrame, kinds: Sequence[SpanKind], cache: DataFrame,
    service: Callable[[DataFrame], DataFrame], doc: str = "doc_id", text: str = "text",
    limit: int = CHUNK_CHARS, **skew: int,
) -> tuple[DataFrame, DataFrame]:
    """Mask, chunk, translate through the cache, join the chunks, unmask.

    Returns ``(doc, translated)`` of every document and the fresh cache entries.
    A NULL document stays NULL. Masking and chunking run once: both tables are
    written before they are read several times.
    """
    masked = materialise(mask_spans(docs, kinds, text).select(doc, "masked", "spans"), "masked")
    chunks = materialise(chunk_text(masked, doc, "masked", limit), "chunks")
    done, fresh = translate(
        chunks.withColumnRenamed("chunk", "text"), cache, service, [doc, "chunk_no"], **skew)
    position = done.withColumn("chunk_no", F.col("chunk_no").cast("bigint"))
    whole = concat_ordered(position, [doc], "chunk_no", "translated", part_chars=1 << 30)
    answered = whole.select(doc, F.col("text").alias("__whole"))
    joined = masked.join(answered, doc, "left").select(
        doc, F.when(F.col("masked").isNotNull(), F.col("__whole")).alias("masked"), "spans")
    back = unmask(joined, kinds, out="translated")
    return back.select(doc, "translated"), fresh


def residual_report(
    docs: DataFrame, flag: Callable[[Column], Column], by: Sequence[str], text: str
) -> DataFrame:
    """Lines and suspicious lines per group, counted inside each document's row."""
    lines = tx.lines(text)
    rows = docs.select(
        *by, F.coalesce(F.size(lines), F.lit(0)).alias("__n"),
        F.coalesce(F.size(F.filter(lines, lambda line: flag(line))), F.lit(0)).alias("__flagged"))
    return rows.filter("__n > 0").groupBy(*by).agg(
        F.sum("__n").alias("n_lines"), F.sum("__flagged").alias("n_residual"))
