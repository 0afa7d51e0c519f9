"""Registry, shared views, and their SQL spellings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.operators.blocks import explode_lines
from corpusprep.operators.spans import SpanKind
from corpusprep.sources.readers import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """The documents, spread for pattern-heavy work."""
    return spread(table(spark, sf, "documents"), "doc_id")


# -- marked blocks on events ------------------------------------------------

def marked_blocks(events: DataFrame) -> DataFrame:
    """Events as blocks: the user is the document; views and clicks mark pages."""
    page = F.when(
        F.col("event_type").isin("view", "click"), F.get_json_object("props", "$.k").cast("int"))
    return events.select(
        F.col("user_id").alias("doc"), F.col("event_id").alias("pos"),
        F.col("event_type").alias("kind"), page.alias("page"),
        F.concat_ws("#", "event_type", F.col("event_id").cast("string")).alias("text"),
    )


def ev(spark: SparkSession, sf: str) -> DataFrame:
    return marked_blocks(table(spark, sf, "events"))


def with_pages(blocks: DataFrame) -> DataFrame:
    return blocks.withColumn("pages", F.array_compact(F.array("page")))


def kind(*names: str) -> Column:
    return F.col("kind").isin(*names)


EV = """ev AS (
  SELECT user_id AS doc, event_id AS pos, event_type AS kind,
         CASE WHEN event_type IN ('view', 'click')
              THEN CAST(json_extract_string(props, '$.k') AS INT) END AS page,
         event_type || '#' || event_id AS text
  FROM events)"""

# -- document lines ---------------------------------------------------------


def ln(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    docs = documents(spark, sf)
    if not extra:
        return explode_lines(docs)
    return docs.select("doc_id", *extra, F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


LN = """ln AS (
  SELECT doc_id, lang, source, CAST(i - 1 AS INT) AS line_no, ls[i] AS line
  FROM (SELECT doc_id, lang, source, ls, unnest(range(1, len(ls) + 1)) AS i
        FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS ls FROM documents)))"""

# -- protected spans on documents --------------------------------------------

SP = (
    SpanKind("licence", "LICBLK", r"(?:This work is licensed|Licensed|Released) under [^\n]*", True, " under "),
    SpanKind("email", "EMLINL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", hint="@"),
    SpanKind("secret", "HEXINL", r"[0-9a-f]{40}"),
    SpanKind("address", "ADRINL", r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"),
    SpanKind("number", "NUMINL", r"[0-9]{16}"),
)


def lit(s: str) -> str:
    """An SQL string literal that may hold newlines."""
    parts = ["'" + p.replace("'", "''") + "'" for p in s.split("\n")]
    return "(" + " || chr(10) || ".join(parts) + ")"


def sql_weave(text: str, pattern: str, shown: str) -> str:
    pairs = f"list_zip(string_split_regex({text}, {lit(pattern)}), {shown})"
    return f"array_to_string(list_transform({pairs}, lambda z: z[1] || coalesce(z[2], '')), '')"


def sql_mask(name: str, source: str, columns: Sequence[str], text: str = "text",
             kinds: Sequence[SpanKind] = SP) -> str:
    """CTEs ending in ``name``: the source's columns, ``masked``, and ``s_<kind>`` lists."""
    ctes = [f"{name}_0 AS (SELECT {', '.join(columns)}, {text} AS masked FROM {source})"]
    for i, k in enumerate(kinds, 1):
        found = f"regexp_extract_all(masked, {lit(k.pattern)})"
        tokens = (f"list_transform({found}, lambda m, i: "
                  f"{lit(k.pad)} || '{k.prefix}' || format('{{:04d}}', i - 1) || 'X' || {lit(k.pad)})")
        ctes.append(
            f"{name}_{i} AS (SELECT * EXCLUDE (masked), {found} AS s_{k.name}, "
            f"{sql_weave('masked', k.pattern, tokens)} AS masked FROM {name}_{i - 1})")
    ctes.append(f"{name} AS (SELECT * FROM {name}_{len(kinds)})")
    return ",\n".join(ctes)


def sql_unmask(name: str, source: str, text: str = "masked",
               kinds: Sequence[SpanKind] = SP) -> str:
    """CTEs ending in ``name``: the source with ``restored``; tokens must be in order."""
    ctes = [f"{name}_0 AS (SELECT *, {text} AS restored FROM {source})"]
    for i, k in enumerate(kinds, 1):
        pattern = rf"\s*{k.prefix}\d{{4,}}X\s*"
        gaps = f"string_split_regex(restored, {lit(pattern)})"
        back = (
            f"array_to_string(list_transform({gaps}, lambda g, i: g || CASE WHEN i > len(s_{k.name}) THEN '' "
            f"WHEN i > 1 AND g = '' THEN s_{k.name}[i] || {lit(k.pad)} "
            f"ELSE {lit(k.pad)} || s_{k.name}[i] || {lit(k.pad)} END), '')")
        ctes.append(f"{name}_{i} AS (SELECT * EXCLUDE (restored), {back} AS restored FROM {name}_{i - 1})")
    ctes.append(
        f"{name} AS (SELECT * EXCLUDE (restored), regexp_replace(restored, '\\n{{3,}}', "
        f"chr(10) || chr(10), 'g') AS restored FROM {name}_{len(kinds)})")
    return ",\n".join(ctes)


# -- languages ---------------------------------------------------------------

# The most frequent words of each language that no other language shares.
MARKERS = {
    "en": ("the", "of", "and", "to", "is", "that", "it"),
    "fr": ("le", "les", "et", "du", "une"),
    "de": ("der", "die", "und", "den", "von", "zu", "das", "mit"),
    "es": ("el", "y", "los", "se", "del", "las", "por"),
}
GLOSSARY = {"le": "the", "les": "the", "et": "and", "du": "of the", "une": "a", "la": "the"}
PHRASES = {"de la": "of the", "que le": "that the"}


def sql_hits(text: str, words: Sequence[str]) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return (
        f"len(list_filter(string_split_regex(lower({text}), '[^\\p{{L}}\\p{{N}}_]+'), "
        f"lambda t: t IN ({listed})))"
    )


def sql_glossary(text: str, words: dict[str, str]) -> str:
    """Whole-word replacement keeping the case; single words only."""
    word = r"[\p{L}\p{N}_]+"
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in words.items())
    put = f"CASE lower(t) {cases} ELSE NULL END"
    cased = (
        f"list_transform(regexp_extract_all({text}, '{word}'), lambda t: CASE "
        f"WHEN {put} IS NULL THEN t "
        f"WHEN t = upper(t) AND t <> lower(t) THEN upper({put}) "
        f"WHEN t <> lower(t) AND t = upper(t[1:1]) || lower(t[2:]) THEN upper(({put})[1:1]) || lower(({put})[2:]) "
        f"ELSE {put} END)"
    )
    return sql_weave(text, word, cased)
