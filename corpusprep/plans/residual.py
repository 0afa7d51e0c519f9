"""A second pass over text left in the wrong language."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.operators.blocks import split_blocks
from corpusprep.operators.concat import PART_CHARS, concat_ordered
from corpusprep.operators.packing import BATCH_CHARS, pack_batches
from corpusprep.operators.residual import translate_segments
from corpusprep.operators.spans import SpanKind, mask_spans, unmask
from corpusprep.session import materialise


def residual_pass(
    docs: DataFrame, kinds: Sequence[SpanKind], flag: Callable[[Column], Column],
    service: Callable[[Column], Column], doc: str = "doc_id", text: str = "text",
    boundary: str = r"\n\s*\n+", limit: int = BATCH_CHARS, part_chars: int = PART_CHARS,
) -> DataFrame:
    """Send the blocks that ``flag`` picks through ``service`` and put the answers back.

    Spans are masked first and restored at the end. Picked blocks go out in batches per
    document. Returns ``(doc, part, residual, n_blocks, n_sent)``; documents without a
    block, NULL ones among them, come back with a NULL text in part 0.
    """
    masked = materialise(mask_spans(docs, kinds, text).select(doc, "masked", "spans"), "masked")
    blocks = materialise(split_blocks(masked, doc, "masked", boundary).withColumnRenamed("masked", "text"), "blocks")
    picked = blocks.filter(F.coalesce(flag(F.col("text")), F.lit(False)))
    batches = pack_batches(picked, [doc], F.length("text"), "pos", limit)
    sent = picked.join(batches, [doc, "pos"])
    back = translate_segments(sent, [doc, "batch"], service, "pos").select(doc, "pos", F.col("text").alias("__answer"))
    merged = blocks.join(back, [doc, "pos"], "left").select(
        doc, F.col("pos").cast("bigint").alias("pos"), F.coalesce("__answer", "text").alias("text"),
        F.col("__answer").isNotNull().cast("int").alias("__sent"))
    merged = materialise(merged, "merged")
    whole = concat_ordered(merged, [doc], "pos", "text", part_chars=part_chars)
    counts = merged.groupBy(doc).agg(F.sum("__sent").cast("int").alias("n_sent"))
    joined = masked.select(doc, "spans").join(whole.join(counts, doc), doc, "left")
    done = unmask(joined.withColumnRenamed("text", "masked"), kinds, out="residual")
    return done.select(
        doc, F.coalesce("part", F.lit(0)).alias("part"), "residual", F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"),
        F.coalesce("n_sent", F.lit(0)).alias("n_sent"))
