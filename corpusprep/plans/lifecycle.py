"""The whole way of marked blocks to finished chunks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.operators import sequence as sq
from corpusprep.operators.rules import Rule, rewrite
from corpusprep.operators.scan import Cutting, chosen
from corpusprep.operators.spans import SpanKind
from corpusprep.plans.export import export_chunks
from corpusprep.plans.residual import residual_pass
from corpusprep.session import materialise


def export_lifecycle(
    blocks: DataFrame, keys: Sequence[str], *, section: Column, heading: Column, appendix: Column, end_matter: Column,
    rules: Sequence[Rule], dropped: Column, contaminated: Column, ref: Column, style: Callable[[Column], Column],
    residual: Callable[[Column], Column], service: Callable[[Column], Column], restyle: Callable[[Column], Column],
    kinds: Sequence[SpanKind] = (), margin: int = 60, pos: str = "pos", page: str = "page", pages: str = "pages",
    text: str = "text", bits: Cutting = None, **export: int,
) -> DataFrame:
    """``(*keys, start_page, end_page, part, piece, page_range, text, n_blocks, n_sent)``, a row per chunk part.

    End matter goes first, then texts are cleaned by ``rules``, sections that ``dropped`` opens go up to the next
    heading, and what is left is exported in page chunks. Blocks of a chunk that ``residual`` still picks are sent
    through ``service``, protected spans apart, and the chunk's text is styled once more. How keys are cut is
    decided once, by the blocks that come in. A chunk part without text is kept, with nothing sent.
    """
    keys = list(keys)
    bits = chosen(blocks, keys, bits)
    ranges = sq.tail_ranges(blocks, keys, section, heading, appendix, end_matter, pos, page, margin, bits)
    left = sq.remove_ranges(blocks, ranges, keys, pos, bits)
    kept = sq.drop_sections(rewrite(left, rules, text), keys, dropped, heading, pos, bits)
    chunks = export_chunks(
        kept, keys, contaminated, ref, style, pos, page, pages, text, bits=bits, **export)
    # The chunks are read by the second pass and for what it leaves as it is.
    name = F.to_json(F.struct(*keys, "start_page", "part"))
    held = materialise(chunks.withColumn("__chunk", name), "chunks")
    second = residual_pass(held, kinds, residual, service, "__chunk", text).select(
        "__chunk", F.col("part").alias("__part"), "residual", "n_sent")
    done = held.join(second, "__chunk", "left")
    # A second pass that cuts a part again numbers its pieces within it.
    return done.select(
        *keys, "start_page", "end_page", "part", F.coalesce("__part", F.lit(0)).alias("piece"), "page_range",
        restyle(F.coalesce("residual", text)).alias(text), "n_blocks", F.coalesce("n_sent", F.lit(0)).alias("n_sent"))
