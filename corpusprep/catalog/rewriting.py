"""Rule-driven rewriting, envelopes, and the flagship report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.catalog.base import (
    GLOSSARY, SP, documents, query, sql_glossary, sql_mask, sql_unmask, table)
from corpusprep.catalog.reports import residual_flag, sql_residual
from corpusprep.operators.packing import pack_batches
from corpusprep.operators.residual import translate_segments
from corpusprep.operators.rules import Rule, guarded, rewrite, wrap_unfenced
from corpusprep.operators.spans import SpanKind, mask_spans
from corpusprep.plans.residual import residual_pass
from corpusprep.plans.translate import residual_report, rewrite_protected

CLEANUP = (
    Rule("symbol_runs", r"\$\$\$|%%%|###|&&&|\*\*\*", ""),
    Rule("blank_runs", r"[ \t]{2,}", " "),
    Rule("blank_before_mark", r" +([,.;:])", "$1"),
    Rule("mark_runs", r",{2,}", ","),
    Rule("newline_runs", r"\n{3,}", "\n\n"),
)


def sql_rules(text: str, rules) -> str:
    for r in rules:
        put = "(" + " || chr(10) || ".join(
            "'" + p.replace("$1", "\\1").replace("$2", "\\2").replace("'", "''") + "'"
            for p in r.replacement.split("\n")) + ")"
        if r.kind == "literal":
            text = f"replace({text}, '{r.pattern}', {put})"
        else:
            text = f"regexp_replace({text}, '{r.pattern}', {put}, 'g')"
    return text


@query("clean_text", f"SELECT doc_id, {sql_rules('text', CLEANUP)} AS text FROM documents")
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return rewrite(documents(spark, sf).select("doc_id", "text"), CLEANUP)


STYLE = (
    Rule("licence_heading", r"(?m)^(Released under) (.+)$", "# $1\n\n$2"),
    Rule("licence_lead", r"(?m)^Licensed under ", "LICENCE: "),
    Rule("long_lead", "This work is licensed under", "LICENCE:", "literal"),
    Rule("version", r", [Vv]ersion ([0-9])", " v$1"),
    Rule("heading_map", "# Released under", "# LICENCE", "literal"),
    Rule("newline_runs", r"\n{3,}", "\n\n"),
)


@query("export_style", f"SELECT doc_id, {sql_rules('text', STYLE)} AS text FROM documents")
def export_style(spark: SparkSession, sf: str) -> DataFrame:
    return rewrite(documents(spark, sf).select("doc_id", "text"), STYLE)


@query("guarded_rewrite", f"""
WITH {sql_mask('m', 'documents', ['doc_id', 'text'])},
f AS (SELECT doc_id, text, regexp_replace(masked, 'LICBLK[0-9]+X', '', 'g') AS full_text FROM m),
g AS (SELECT *, regexp_matches(full_text, '(?:EML|HEX|ADR|NUM)INL[0-9]+X') AS leak FROM f)
SELECT doc_id, CAST(leak AS INT) AS fell_back,
       CASE WHEN leak THEN {sql_rules('text', CLEANUP)} ELSE full_text END AS text FROM g""")
def guarded_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    masked = mask_spans(documents(spark, sf).select("doc_id", "text"), SP)
    leak = "(?:EML|HEX|ADR|NUM)INL[0-9]+X"
    full = masked.withColumn("full_text", F.regexp_replace("masked", "LICBLK[0-9]+X", ""))
    both = rewrite(full, CLEANUP, "text", "safe_text")
    return both.select(
        "doc_id", F.col("full_text").rlike(leak).cast("int").alias("fell_back"),
        guarded(F.col("full_text"), F.col("safe_text"), leak).alias("text"))


SECRET = SpanKind("secret", "SECINL", r'token = "[0-9a-f]{40}"')
WRAP_TRIGGER, WRAP_PROSE = r"\$\$\$|%%%|###|&&&|\*\*\*", r"\p{L}{14,}"


@query("wrap_unfenced", rf"""
SELECT doc_id, array_to_string(list_transform(string_split(replace(text, '&&&&&&', '&&&'), chr(10)), lambda x: CASE
    WHEN length(trim(x)) > 0 AND NOT regexp_matches(x, '{SECRET.pattern}') AND NOT regexp_matches(x, '{WRAP_PROSE}')
      AND regexp_matches(x, '{WRAP_TRIGGER}') AND NOT regexp_matches(x, '^[\s|\-]+$')
    THEN '$$' || chr(10) || trim(x) || chr(10) || '$$' ELSE x END), chr(10)) AS wrapped
FROM documents""")
def wrap_lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text")
    return wrap_unfenced(docs, [SECRET], WRAP_TRIGGER, WRAP_PROSE, environments=("cases", "array"),
                         typos={"&&&&&&": "&&&"}).select("doc_id", "wrapped")


@query("envelope_roundtrip", """
WITH RECURSIVE o AS (SELECT conv_id, turn, text, length(text) + 32 AS w,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations),
walk AS (
  SELECT conv_id, turn, text, rn, w AS fill, CAST(0 AS BIGINT) AS batch FROM o WHERE rn = 1
  UNION ALL
  SELECT o.conv_id, o.turn, o.text, o.rn, CASE WHEN fill + w > 2000 THEN w ELSE fill + w END,
         batch + CASE WHEN fill + w > 2000 THEN 1 ELSE 0 END
  FROM walk JOIN o ON o.conv_id = walk.conv_id AND o.rn = walk.rn + 1),
sized AS (SELECT *, count(*) OVER (PARTITION BY conv_id, batch) AS n FROM walk)
SELECT conv_id, batch, turn, CASE WHEN n >= 3 THEN 'single' ELSE 'batch' END AS via,
       trim(replace(text, 'the ', 'THE '), ' ' || chr(10)) AS text FROM sized""")
def envelope_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    batches = pack_batches(turns, ["conv_id"], F.length("text"), "turn", limit=2000)

    def service(body):
        # Loses the third token of a message, so longer batches must be redone singly.
        return F.replace(F.replace(body, F.lit("the "), F.lit("THE ")), F.lit("TOKEN0002"), F.lit("T"))

    placed = turns.join(batches, ["conv_id", "turn"])
    return translate_segments(placed, ["conv_id", "batch"], service, "turn")


SENT = r"(?:\$\$\$|%%%)"


@query("residual_pass", f"""
WITH l AS (SELECT doc_id, i, trim(ss[i]) AS s FROM (
  SELECT doc_id, ss, unnest(range(1, len(ss) + 1)) AS i FROM (
    SELECT doc_id, string_split(text, chr(10)) AS ss FROM documents))),
b AS (SELECT *, regexp_matches(s, '{SENT}') AS sent FROM l WHERE s <> '')
SELECT doc_id, 0 AS part, CAST(count(*) AS INT) AS n_blocks, CAST(sum(CAST(sent AS INT)) AS INT) AS n_sent,
       string_agg(CASE WHEN sent THEN replace(s, 'e', 'E') ELSE s END, chr(10) || chr(10) ORDER BY i) AS residual
FROM b GROUP BY doc_id""")
def residual_pass_over_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with symbol runs are sent out; the service marks what it has seen."""
    bell = SpanKind("bell", "BELINL", r"\x07[^\x07]*\x07", hint="\x07")
    return residual_pass(
        documents(spark, sf), (bell,), lambda t: t.rlike(SENT), lambda t: F.replace(t, F.lit("e"), F.lit("E")),
        boundary="\n", limit=2000)


FLAGSHIP = f"""
WITH {sql_mask('m', 'documents', ['doc_id', 'lang', 'source'])},
g AS (SELECT * EXCLUDE (masked), {sql_glossary('masked', GLOSSARY)} AS masked FROM m),
{sql_unmask('u', 'g')},
l AS (SELECT doc_id, lang, source, trim(unnest(string_split(restored, chr(10)))) AS line FROM u)
SELECT source, quality, count(*) AS n_lines, count(*) FILTER (WHERE {sql_residual('line', 'lang')}) AS n_residual
FROM l LEFT JOIN labels USING (doc_id) GROUP BY source, quality"""


@query("residual_after_rewrite", FLAGSHIP)
def residual_after_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """Rewrite all but the protected spans, then report what is still in another language."""
    docs = documents(spark, sf).select("doc_id", "text", "lang", "source")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    rewritten = rewrite_protected(docs, SP, GLOSSARY)
    # Counts shrink to one row per document before the join: labels never meet lines.
    per_doc = residual_report(rewritten, residual_flag, ["doc_id", "source", "lang"], "restored")
    return per_doc.join(labels, "doc_id", "left").groupBy("source", "quality").agg(
        F.sum("n_lines").alias("n_lines"), F.sum("n_residual").alias("n_residual"))
