"""Finding text left in the wrong language, and sending it out in batches."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.session import materialise


@dataclass(frozen=True)
class Detector:
    """What gives a wrong language away. Patterns are Java; NULL patterns never match."""

    markers: Sequence[str]
    letters: str | None = None
    words: str | None = None
    script: str | None = None
    caption_prefix: str = r"(?iU)^(?:fig\.)"
    short_prefix: str = r"(?iU)^#{1,6}\s+"


def marker_hits(text: Column | str, markers: Sequence[str]) -> Column:
    """Whole-word occurrences of any marker."""
    return tx.count_matches(F.lower(tx.col(text)), tx.whole_words(m.lower() for m in markers))


def needs_residual(text: Column | str, d: Detector) -> Column:
    """Does a block need another translation pass.

    Fences and images never do. Long blocks need two markers or one strong sign;
    medium ones two markers; headings and captions in the script any sign; short
    structural lines a strong sign, or the script and a marker.
    """
    body = tx.strip(text)

    def has(pattern: str | None) -> Column:
        return F.lit(False) if pattern is None else body.rlike(pattern)

    hits = marker_hits(body, d.markers)
    strong = has(d.letters) | has(d.words)
    script = has(d.script)
    titled = body.startswith("#") | body.rlike(d.caption_prefix)
    size = F.length(body)
    return (
        F.when(body.rlike(r"^(?:```|~~~|!\[\]\()"), False)
        .when(size >= 80, (hits >= 2) | strong)
        .when((size >= 35) & (hits >= 2), True)
        .when(titled & script, (hits >= 1) | strong)
        .when((size >= 8) & body.rlike(d.short_prefix), strong | (script & (hits >= 1)))
        .otherwise(False)
    )


def per_language(lang: Column | str, detect: Callable[[str], Column], langs: Sequence[str],
                 default: Column) -> Column:
    """One expression per language of the text, evaluated only for its own rows."""
    lang = tx.col(lang)
    out = None
    for code in langs:
        out = (F if out is None else out).when(lang == code, detect(code))
    return default if out is None else out.otherwise(default)


def foreign_detectors(markers: Mapping[str, Sequence[str]]) -> dict[str, Detector]:
    """For each language, a detector of all the others."""
    return {
        lang: Detector(markers=[m for other, ms in markers.items() if other != lang for m in ms])
        for lang in markers
    }


def residual_documents(blocks: DataFrame, flag: Column, keys: Sequence[str]) -> DataFrame:
    """Documents with at least one block that qualifies: ``(*keys, n_blocks)``."""
    return blocks.filter(flag).groupBy(*keys).agg(F.count("*").alias("n_blocks"))


TOKEN = "SEGMENTTOKEN%04dXYZ"
TOKEN_PATTERN = r"SEGMENTTOKEN\d{4,}XYZ"


def batch_envelopes(segments: DataFrame, batch_keys: Sequence[str], pos: str = "pos",
                    text: str = "text") -> DataFrame:
    """One message per batch: token line and text of each segment.

    Batches come from ``pack_batches``, so a group is bounded by the batch limit.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(pos), tx.strip(text).alias("t"))))
    grouped = segments.groupBy(*batch_keys).agg(ordered.alias("segments"))
    parts = F.transform("segments", lambda s, i: F.concat(
        F.format_string(TOKEN + "\n", i), s["t"]))
    return grouped.withColumn("body", F.array_join(parts, "\n\n"))


def unpack_envelopes(answers: DataFrame, batch_keys: Sequence[str], pos: str = "pos",
                     body: str = "answer") -> DataFrame:
    """Segments of the answered batches: ``(*batch_keys, pos, intact, source, text)``.

    Tokens are matched by number, in whatever order they come back. If any is
    lost the whole batch is marked not intact, with NULL texts, to be redone
    segment by segment.
    """
    expected = F.transform("segments", lambda _s, i: F.format_string(TOKEN, i))
    found = tx.find_all(body, TOKEN_PATTERN)
    pieces = F.split(F.col(body), TOKEN_PATTERN, -1)
    read = answers.withColumns({"__found": found, "__pieces": pieces})
    intact = F.size(F.array_except(expected, "__found")) == 0
    row = F.transform("segments", lambda s, i: F.struct(
        s[pos].alias(pos), s["t"].alias("source"),
        tx.strip(F.get("__pieces", F.array_position("__found", F.format_string(TOKEN, i)).cast("int")))
        .alias("text")))
    flat = read.select(*batch_keys, intact.cast("int").alias("intact"), F.inline(row))
    return flat.withColumn("text", F.when(F.col("intact") == 1, F.col("text")))


def translate_segments(
    segments: DataFrame, batch_keys: Sequence[str], service: Callable[[Column], Column],
    pos: str = "pos", text: str = "text",
) -> DataFrame:
    """Send batches through ``service``; redo lost batches singly. Empty answers keep the source.

    The batches' answers are written before they are read twice, and only segments of
    lost batches are sent singly, so nothing is asked for again.
    """
    sent = materialise(
        batch_envelopes(segments, batch_keys, pos, text).withColumn("answer", service(F.col("body"))), "answers")
    back = unpack_envelopes(sent, batch_keys, pos)
    whole = back.filter("intact = 1").withColumn("via", F.lit("batch"))
    single = back.filter("intact = 0").withColumns({
        "via": F.lit("single"), "text": tx.strip(service(F.col("source")))})
    return whole.unionByName(single).select(
        *batch_keys, pos, "via",
        F.when(F.length("text") > 0, F.col("text")).otherwise(F.col("source")).alias("text"),
    )
