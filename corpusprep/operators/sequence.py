"""Ordered-block operators: page inheritance, filters, sections, ranges, fences.

Blocks carry ``pos``, unique within their keys. ``page`` is the block's page
marker, NULL on an unmarked block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.operators.concat import PART_CHARS, concat_ordered
from corpusprep.operators.lookup import estimated_bytes
from corpusprep.operators.scan import STRETCH, Cutting, Run, chosen, in_stretches, looking_ahead, running, with_extremes

COUNTED_BYTES = 1 << 20
PART_ROWS = 1 << 18


def inherit_page(blocks: DataFrame, keys: Sequence[str], pos: str = "pos", page: str = "page",
                 name: str = "eff_page", bits: Cutting = None) -> DataFrame:
    """The page of the last marked block at or before each block, else 0."""
    out = running(blocks, keys, pos, {name: Run("last", F.col(page))}, bits)
    return out.withColumn(name, F.coalesce(name, F.lit(0)))


def page_buckets(
    blocks: DataFrame, keys: Sequence[str], pos: str = "pos", pages: str = "pages",
    width: int = 50, bits: Cutting = None,
) -> DataFrame:
    """One row per block and bucket it belongs to, with ``start_page``.

    A block that marks pages of several buckets is in each of them; an unmarked
    one follows the largest page of the last marked block.
    """
    filled = running(
        blocks, keys, pos, {"__last": Run("last", F.array_max(pages))}, bits
    )
    # A block marks a bounded handful of pages, so this grows with the blocks only.
    own = F.when(F.size(F.coalesce(pages, F.array().cast("array<int>"))) > 0, F.col(pages))
    at = F.coalesce(own, F.array(F.coalesce("__last", F.lit(0))))
    starts = F.array_distinct(F.transform(at, lambda p: (p - p % width).cast("int")))
    return filled.withColumn("start_page", F.explode(starts)).drop("__last")


def page_chunks(
    blocks: DataFrame, keys: Sequence[str], pos: str = "pos", pages: str = "pages",
    text: str = "text", width: int = 50, part_chars: int = PART_CHARS, bits: Cutting = None,
) -> DataFrame:
    """Bucket texts in order: ``(*keys, start_page, end_page, part, n_blocks, text)``."""
    keys = list(keys)
    bits = chosen(blocks, keys, bits)
    bucketed = page_buckets(blocks, keys, pos, pages, width, bits)
    ends = blocks.groupBy(*keys).agg(
        F.coalesce(F.max(F.array_max(pages)), F.lit(0)).alias("__max")
    )
    chunks = concat_ordered(bucketed, [*keys, "start_page"], pos, text, part_chars=part_chars, bits=bits)
    return chunks.join(ends, keys).select(
        *keys, "start_page",
        F.least(F.col("start_page") + width - 1, "__max").cast("int").alias("end_page"),
        "part", "n_blocks", "text",
    )


def monotone_filter(
    blocks: DataFrame, keys: Sequence[str], pos: str = "pos", page: str = "page",
    jump: int = 10, bits: Cutting = None,
) -> DataFrame:
    """Drop marked blocks that fall more than ``jump`` pages behind, and what follows them.

    A dropped page is below the maximum, so it cannot raise it: the plain
    running maximum is the maximum over kept blocks.
    """
    given = blocks.columns
    flagged = monotone_flags(blocks, keys, pos, page, jump, bits)
    return flagged.filter(F.coalesce("__keep", F.lit(1)) == 1).select(*given)


def monotone_flags(
    blocks: DataFrame, keys: Sequence[str], pos: str = "pos", page: str = "page",
    jump: int = 10, bits: Cutting = None,
) -> DataFrame:
    """The same with the decision kept: ``__keep`` is 1, 0, or NULL before any marker."""
    bits = chosen(blocks, keys, bits)
    highest = running(
        in_stretches(blocks, pos, bits), keys, pos, {"__mx": Run("max", F.col(page), inclusive=False)}, bits
    )
    decided = F.when(
        F.col(page).isNotNull(),
        F.when(F.col(page) < F.col("__mx") - jump, 0).otherwise(1),
    )
    return running(highest, keys, pos, {"__keep": Run("last", decided)}, bits).drop("__mx", STRETCH)


def window_filter(
    blocks: DataFrame, keys: Sequence[str], low: Column, high: Column, pos: str = "pos",
    pages: str = "pages", tolerance: int = 8, bits: Cutting = None,
) -> DataFrame:
    """Keep blocks of an expected page window.

    Marked blocks stay when any page lies within it. Unmarked ones stay while
    nothing in the window has been seen, or when the last marker was in it.
    """
    given = blocks.columns
    bottom, top = F.greatest(F.lit(0), low - tolerance), high + tolerance
    marked = F.size(F.coalesce(pages, F.array().cast("array<int>"))) > 0
    inside = F.when(
        marked, F.exists(pages, lambda p: (p >= bottom) & (p <= top)).cast("int")
    )
    state = running(
        blocks.withColumn("__in", inside), keys, pos,
        {"__seen": Run("max", F.col("__in")), "__lm": Run("last", F.col("__in"))}, bits,
    )
    calm = (F.coalesce("__seen", F.lit(0)) == 0) | (F.col("__lm") == 1)
    return state.filter((F.col("__in") == 1) | (F.col("__in").isNull() & calm)).select(*given)


def drop_sections(
    blocks: DataFrame, keys: Sequence[str], opens: Column, heading: Column, pos: str = "pos",
    bits: Cutting = None,
) -> DataFrame:
    """Drop each section whose heading matches ``opens``, up to the next other heading."""
    given = blocks.columns
    mark = F.when(opens, 1).when(heading, 0)
    state = running(blocks, keys, pos, {"__skip": Run("last", mark)}, bits)
    return state.filter(F.coalesce("__skip", F.lit(0)) == 0).select(*given)


def page_asof(
    points: DataFrame, markers: DataFrame, keys: Sequence[str], off: str = "off",
    page: str = "page", bits: Cutting = None,
) -> DataFrame:
    """Points with the largest page marked at or before their offset, 0 if none.

    ``points`` has unique offsets within a key, as has ``markers``.
    """
    keys = list(keys)
    both = _interleaved(points.select(*keys, off), markers, keys, off, {page: "int"}, first=True)
    seen = running(both, keys, "__at", {"__p": Run("max", F.col(page))}, bits)
    return seen.filter("__point").select(
        *keys, off, F.coalesce("__p", F.lit(0)).alias("page_asof")
    )


def next_marker(
    points: DataFrame, markers: DataFrame, keys: Sequence[str], off: str = "off", bits: Cutting = None
) -> DataFrame:
    """Points with the offset of the first marker after theirs, NULL if none."""
    keys = list(keys)
    at = markers.select(*keys, off, F.col(off).alias("__m"))
    both = _interleaved(points.select(*keys, off), at, keys, off, {"__m": "bigint"}, first=True)
    seen = running(
        both, keys, "__at", {"next_off": Run("min", F.col("__m"), inclusive=False, backward=True)}, bits
    )
    return seen.filter("__point").select(*keys, off, "next_off")


def _interleaved(
    points: DataFrame, others: DataFrame, keys: list[str], off: str, extra: dict[str, str], first: bool
) -> DataFrame:
    """Both row sets on one axis; at equal offsets ``others`` come first if ``first``."""
    left = points.select(
        *keys, off, *[F.lit(None).cast(t).alias(n) for n, t in extra.items()],
        F.lit(True).alias("__point"), (F.col(off) * 2 + int(first)).alias("__at"),
    )
    right = others.select(
        *keys, off, *[F.col(n).cast(t).alias(n) for n, t in extra.items()],
        F.lit(False).alias("__point"), (F.col(off) * 2 + int(not first)).alias("__at"),
    )
    return left.unionByName(right)


def tail_ranges(
    blocks: DataFrame, keys: Sequence[str], section: Column, heading: Column, appendix: Column,
    end_matter: Column, pos: str = "pos", page: str = "page", margin: int = 60, bits: Cutting = None,
) -> DataFrame:
    """Ranges to remove near the end of a document: ``(*keys, s, e, label)``, ``e`` excluded.

    Only headings on or past ``max(1, max_page - margin)`` count, or any when a
    document has no page markers. A section runs to the next heading, an
    appendix to the next end matter, end matter from its first heading to the end.
    """
    keys = list(keys)
    at = F.col(pos)
    seen = running(
        blocks, keys, pos,
        {
            "__page": Run("max", F.col(page)),
            "__later": Run("max", F.col(page), inclusive=False, backward=True),
            "__heading": Run("min", F.when(heading, at), inclusive=False, backward=True),
            "__matter": Run("min", F.when(end_matter, at), inclusive=False, backward=True),
            "__rest": Run("max", at, backward=True),
        },
        bits,
    )
    top = F.greatest("__page", "__later")
    cutoff = F.when(top.isNull(), 0).otherwise(F.greatest(F.lit(1), top - margin))
    late = seen.filter((section | appendix | end_matter) & (F.coalesce("__page", F.lit(0)) >= cutoff))
    stop = F.col("__rest") + 1
    kinds = F.array(
        F.when(section, F.struct(F.lit("section").alias("label"), F.coalesce("__heading", stop).alias("e"))),
        F.when(appendix, F.struct(F.lit("appendix").alias("label"), F.coalesce("__matter", stop).alias("e"))),
        F.when(end_matter, F.struct(F.lit("tail").alias("label"), stop.alias("e"))),
    )
    hits = late.select(*keys, at.alias("s"), F.inline(F.array_compact(kinds)))
    # The earliest end matter alone cuts the tail: its headings share one group, in
    # which a partial minimum is left; every other hit is a group of its own.
    own = F.when(F.col("label") != "tail", F.col("s"))
    return hits.groupBy(*keys, "label", own.alias("__own")).agg(
        F.min("s").alias("s"), F.max("e").alias("e")
    ).select(*keys, "s", "e", "label")


def merge_ranges(ranges: DataFrame, keys: Sequence[str], bits: Cutting = None) -> DataFrame:
    """Merge overlapping or touching ranges: ``(*keys, s, e, n_ranges, labels)``.

    ``labels`` lists each label once with its count and first start, in order of
    first start; so its size follows the label vocabulary, not the ranges.
    """
    keys = list(keys)
    bits = chosen(ranges, keys, bits)
    # Without a hot key one exchange on the keys serves every later grouping and window. All their tables
    # are held at once by a task, so its share is bounded by the number of partitions, which are not merged again.
    parts = 1 if bits or estimated_bytes(ranges) <= COUNTED_BYTES else 1 + ranges.count() // PART_ROWS
    cores = ranges.sparkSession.sparkContext.defaultParallelism
    near = ranges if bits else ranges.repartition(*([max(parts, cores)] if parts > 1 else []), *keys)
    counted = near.groupBy(*keys, "s", "label").agg(F.max("e").alias("e"), F.count("*").alias("n"))
    starts = counted.groupBy(*keys, "s").agg(
        F.max("e").alias("e"), F.collect_list(F.struct("label", "n")).alias("here"))
    reach = running(in_stretches(starts, "s", bits), keys, "s", {"__e": Run("max", F.col("e"), inclusive=False)}, bits)
    opens = F.when(F.col("__e").isNull() | (F.col("s") > F.col("__e")), F.col("s"))
    placed = running(reach, keys, "s", {"island": Run("last", opens)}, bits)
    per_label = placed.select(*keys, "island", "s", "e", F.inline("here")).groupBy(
        *keys, "island", "label"
    ).agg(F.max("e").alias("e"), F.sum("n").alias("n"), F.min("s").alias("first_s"))
    entry = F.struct("first_s", "label", "n")
    return per_label.groupBy(*keys, "island").agg(
        F.max("e").alias("e"),
        F.sum("n").alias("n_ranges"),
        F.array_sort(F.collect_list(entry)).alias("labels"),
    ).select(*keys, F.col("island").alias("s"), "e", "n_ranges", "labels")


def remove_ranges(
    blocks: DataFrame, ranges: DataFrame, keys: Sequence[str], pos: str = "pos", bits: Cutting = None
) -> DataFrame:
    """Drop the blocks inside any range ``[s, e)``.

    A block is inside exactly if the furthest end opened so far lies beyond it:
    one running maximum, no pairing of blocks with ranges.
    """
    keys = list(keys)
    given = blocks.columns
    opened = ranges.groupBy(*keys, "s").agg(F.max("e").alias("__e"))
    rows = blocks.select("*", F.lit(None).cast("bigint").alias("__e"),
                         (F.col(pos) * 2 + 1).alias("__at"), F.lit(True).alias("__block"))
    cuts = opened.select(*keys, F.col("__e").cast("bigint").alias("__e"),
                         (F.col("s") * 2).alias("__at"), F.lit(False).alias("__block"))
    both = rows.unionByName(cuts, allowMissingColumns=True)
    reach = running(both, keys, "__at", {"__reach": Run("max", F.col("__e"))}, bits)
    outside = F.col("__reach").isNull() | (F.col("__reach") <= F.col(pos))
    return reach.filter(F.col("__block") & outside).select(*given)


def dedupe_refs(
    blocks: DataFrame, keys: Sequence[str], ref: Column, pos: str = "pos"
) -> DataFrame:
    """Keep only the first stand-alone reference to a target; ``ref`` is NULL elsewhere.

    The firsts are found with a partial minimum and matched on ``pos``, which is
    unique, so a target that is repeated endlessly makes no large group. Blocks
    without a reference are not moved.
    """
    keys = list(keys)
    tagged = blocks.select("*", ref.alias("__ref"))
    refs = tagged.filter(F.col("__ref").isNotNull())
    firsts = refs.groupBy(*keys, "__ref").agg(F.min(pos).alias(pos)).select(*keys, pos)
    kept = refs.join(firsts, [*keys, pos], "left_semi")
    return tagged.filter(F.col("__ref").isNull()).unionByName(kept).select(*blocks.columns)


def caption_lookahead(
    lines: DataFrame, keys: Sequence[str], anchor: Column, name: Column, text: Column,
    structural: Column, pos: str = "pos", depth: int = 4, bits: Cutting = None,
) -> DataFrame:
    """Captions of anchors: ``(*keys, name, caption)``.

    The first non-blank of the next ``depth`` lines, '' when that is structural;
    of several anchors with one name the last counts.
    """
    keys = list(keys)
    peek = F.struct(text.alias("t"), F.coalesce(structural, F.lit(False)).alias("stop"))
    slim = lines.select(*keys, pos, anchor.alias("__a"), name.alias("name"), peek.alias("__peek"))
    ahead = looking_ahead(slim, keys, pos, F.col("__peek"), depth, "__next", bits)
    first = F.get(F.filter("__next", lambda x: F.length(x["t"]) > 0), F.lit(0))
    caption = F.when(first.isNull() | first["stop"], F.lit("")).otherwise(first["t"])
    return (
        ahead.filter("__a").select(*keys, pos, "name", caption.alias("caption"))
        .groupBy(*keys, "name").agg(F.max_by("caption", pos).alias("caption"))
    )


def fence_state(
    lines: DataFrame, keys: Sequence[str], code: Column, toggle: Column, opens: Column,
    closes: Column, pos: str = "pos", bits: Cutting = None,
) -> DataFrame:
    """State before each line: ``in_code`` and ``in_display``.

    Code fences toggle; a display fence toggles, and explicit openers and
    closers set the display state whatever it was.
    """
    bits = chosen(lines, keys, bits)
    hit = F.when(code, F.lit(None)).when(toggle, 1)
    one = F.when(code, 1).otherwise(0)
    counted = running(
        in_stretches(lines, pos, bits), keys, pos,
        {
            "__codes": Run("sum", one, inclusive=False),
            "__toggles": Run("sum", F.coalesce(hit, F.lit(0)), inclusive=False),
        },
        bits,
    )
    plain = ~F.coalesce(code | toggle, F.lit(False))
    # State after a setter minus the toggles up to it; later toggles add to that.
    anchor = F.when(plain & opens, 1 - F.col("__toggles")).when(plain & closes, -F.col("__toggles"))
    state = running(counted, keys, pos, {"__base": Run("last", anchor, inclusive=False)}, bits)
    display = F.coalesce("__base", F.lit(0)) + F.col("__toggles")
    return state.select(
        *lines.columns,
        (F.col("__codes") % 2).cast("int").alias("in_code"),
        F.pmod(display, F.lit(2)).cast("int").alias("in_display"),
    )


def unsafe_outside_code(
    lines: DataFrame, keys: Sequence[str], unsafe: Column, code: Column, pos: str = "pos",
    bits: Cutting = None,
) -> DataFrame:
    """Unsafe lines that stand outside code fences; fence lines themselves never count."""
    fence = F.coalesce(code, F.lit(False))
    marked = lines.withColumns({"__fence": fence, "__unsafe": F.coalesce(unsafe, F.lit(False))})
    never = F.lit(False)
    state = fence_state(marked, keys, F.col("__fence"), never, never, never, pos, bits)
    return state.filter("in_code = 0 AND NOT __fence AND __unsafe").select(*lines.columns)


def section_starts(
    blocks: DataFrame, keys: Sequence[str], heading: Column, pos: str = "pos", page: str = "page",
    bits: Cutting = None,
) -> DataFrame:
    """First page of each section, carried over where its heading has no marker."""
    keys = list(keys)
    one = F.when(heading, 1).otherwise(0).cast("bigint")
    placed = running(
        blocks, keys, pos, {"section": Run("sum", one), "__page": Run("last", F.col(page))}, bits
    ).withColumn("eff_page", F.coalesce("__page", F.lit(0)))
    return placed.groupBy(*keys, "section").agg(
        F.min_by("eff_page", pos).alias("start_page"), F.count("*").alias("n_blocks")
    )


def edit_section(
    blocks: DataFrame, keys: Sequence[str], starts: Column, ends: Column, replacement: Column,
    pos: str = "pos", text: str = "text", bits: Cutting = None,
) -> DataFrame:
    """Replace everything from the first start up to the first end after it.

    Nothing happens when either is missing, or the first end falls on the start itself.
    """
    at = F.col(pos)
    bits = chosen(blocks, keys, bits)
    began = with_extremes(in_stretches(blocks, pos, bits), keys, pos, {"__s": ("min", F.when(starts, at))}, bits)
    closed = with_extremes(
        began, keys, pos, {"__e": ("min", F.when(ends & (at >= F.col("__s")), at))}, bits
    )
    return _replaced(closed, blocks.columns, F.col("__e") > F.col("__s"), replacement, pos, text)


def edit_nearest(
    blocks: DataFrame, keys: Sequence[str], starts: Column, ends: Column, replacement: Column,
    max_distance: int, pos: str = "pos", text: str = "text", bits: Cutting = None,
) -> DataFrame:
    """Replace from the last start before the first end up to it, unless too far apart."""
    at = F.col(pos)
    bits = chosen(blocks, keys, bits)
    closed = with_extremes(in_stretches(blocks, pos, bits), keys, pos, {"__e": ("min", F.when(ends, at))}, bits)
    began = with_extremes(
        closed, keys, pos, {"__s": ("max", F.when(starts & (at < F.col("__e")), at))}, bits
    )
    near = F.col("__e") - F.col("__s") <= max_distance
    return _replaced(began, blocks.columns, near, replacement, pos, text)


def _replaced(df: DataFrame, columns: list[str], applies: Column, replacement: Column,
              pos: str, text: str) -> DataFrame:
    at = F.col(pos)
    inside = F.coalesce(applies, F.lit(False)) & (at >= F.col("__s")) & (at < F.col("__e"))
    kept = df.filter(~inside | (at == F.col("__s")))
    put = F.when(inside, replacement).otherwise(F.col(text))
    return kept.select(*[put.alias(c) if c == text else F.col(c) for c in columns])
