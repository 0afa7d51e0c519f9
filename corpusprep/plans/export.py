"""From marked blocks to page chunks ready for export."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.operators import sequence as sq
from corpusprep.operators.blocks import drop_contaminated
from corpusprep.operators.concat import PART_CHARS, concat_ordered
from corpusprep.operators.packing import PAGES_PER_CHUNK
from corpusprep.operators.scan import Cutting, chosen, with_extremes
from corpusprep.session import settled


def export_chunks(
    blocks: DataFrame, keys: Sequence[str], contaminated: Column, ref: Column,
    style: Callable[[Column], Column], pos: str = "pos", page: str = "page", pages: str = "pages",
    text: str = "text", width: int = PAGES_PER_CHUNK, tolerance: int = 2, jump: int = 10,
    contaminated_from: int = 150, part_chars: int = PART_CHARS, bits: Cutting = None,
) -> DataFrame:
    """Group by page bucket, filter each bucket, restyle, and join the texts.

    Per bucket: blocks outside its page window go, then blocks far behind, then
    contamination, then repeated references. The result has one row per chunk
    part, with the page range that names it. Large inputs are filtered as slim
    rows, and the texts join what is left, by position.
    """
    keys = list(keys)
    chunk = [*keys, "start_page"]
    bits = chosen(blocks, keys, bits)
    slim = blocks.select(
        *keys, pos, page, pages, contaminated.alias("__contaminated"), ref.alias("__reference"),
        *([] if bits else [text]))
    bounded = with_extremes(slim, keys, pos, {"__max": ("max", F.array_max(pages))}, bits)
    grouped = sq.page_buckets(bounded, keys, pos, pages, width, bits).withColumn(
        "end_page", F.least(F.col("start_page") + width - 1, F.coalesce("__max", F.lit(0))))
    near = sq.window_filter(
        grouped, chunk, F.col("start_page"), F.col("end_page"), pos, pages, tolerance, bits)
    rising = sq.monotone_filter(near, chunk, pos, page, jump, bits)
    clean = drop_contaminated(
        rising, F.col("start_page"), F.col("__contaminated"), contaminated_from)
    single = sq.dedupe_refs(settled(clean) if bits else clean, chunk, F.col("__reference"), pos)
    if bits:
        kept = single.select(*chunk, "end_page", pos)
        single = kept.join(blocks.select(*keys, pos, text), [*keys, pos])
    styled = single.withColumn(text, style(F.col(text)))
    joined = concat_ordered(styled, [*chunk, "end_page"], pos, text, part_chars=part_chars, bits=bits)
    return joined.withColumn("page_range", F.format_string("%03d-%03d", "start_page", "end_page"))
