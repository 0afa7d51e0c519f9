"""Audits and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.catalog.base import EV, LN, MARKERS, documents, ev, kind, ln, query, sql_hits, table
from corpusprep.operators import audit as au
from corpusprep.operators import residual as re_
from corpusprep.model import EDITS
from corpusprep.operators.edits import apply_edits, edit_counts
from corpusprep.operators.rules import Rule, rule_hits


@query("sequence_audit", """
SELECT l_orderkey, CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_present,
       CAST(max(l_linenumber) - count(*) AS BIGINT) AS n_missing, count(*) FILTER (WHERE c > 1) AS n_duplicated
FROM (SELECT l_orderkey, l_linenumber, count(*) AS c FROM lineitem GROUP BY ALL) GROUP BY l_orderkey""")
def sequence_audit(spark: SparkSession, sf: str) -> DataFrame:
    return au.sequence_audit(table(spark, sf, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("missing_numbers", """
SELECT l_orderkey, CAST(n AS BIGINT) AS missing
FROM (SELECT l_orderkey, unnest(range(1, max(l_linenumber) + 1)) AS n FROM lineitem GROUP BY l_orderkey)
EXCEPT SELECT l_orderkey, CAST(l_linenumber AS BIGINT) FROM lineitem""")
def missing_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return au.missing_numbers(table(spark, sf, "lineitem"), ["l_orderkey"], "l_linenumber")


def _n(pattern: str) -> str:
    return f"CAST(sum(len(regexp_extract_all(text, '{pattern}'))) AS BIGINT)"


@query("pair_balance", f"""
WITH s AS (SELECT source, {_n('[(]')} AS o, {_n('[)]')} AS c, {_n('^[A-Z]')} AS o2, {_n('[.]$')} AS c2
           FROM documents GROUP BY source)
SELECT source, 'paren' AS pair, o AS n_open, c AS n_close, o - c AS deficit FROM s
UNION ALL SELECT source, 'sentence', o2, c2, o2 - c2 FROM s""")
def pair_balance(spark: SparkSession, sf: str) -> DataFrame:
    pairs = (("paren", r"\(", r"\)"), ("sentence", r"^[A-Z]", r"[.]$"))
    return au.pair_balance(documents(spark, sf), ["source"], pairs)


@query("table_width", r"""
SELECT doc_id, CAST(list_max(list_transform(list_filter(string_split(text, chr(10)), lambda x: length(trim(x)) > 0),
         lambda x: len(regexp_extract_all(x, ' \| ')) + 1)) AS INT) AS width
FROM documents WHERE contains(text, ' | ')""")
def table_width(spark: SparkSession, sf: str) -> DataFrame:
    tables = documents(spark, sf).filter(F.col("text").contains(" | "))
    return tables.select("doc_id", au.table_width("text").alias("width"))


@query("build_status", """
SELECT o_orderpriority, CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'OK' ELSE 'RECOVERABLE' END AS status,
       count(*) AS n
FROM orders GROUP BY ROLLUP (o_orderpriority, status)""")
def build_status(spark: SparkSession, sf: str) -> DataFrame:
    state = F.when(F.col("o_orderstatus") == "F", "FAILED").when(
        F.col("o_orderstatus") == "O", "OK").otherwise("RECOVERABLE")
    builds = table(spark, sf, "orders").select("o_orderpriority", state.alias("status"))
    return au.build_status(builds, "o_orderpriority", "status")


AUDIT_RULES = (
    Rule("dollar_run", r"\$\$\$"),
    Rule("percent_run", r"%%%"),
    Rule("licence", r"(?m)^(?:This work is licensed|Licensed|Released) under "),
    Rule("secret", r'token = "[0-9a-f]{40}"'),
    Rule("space_before_comma", r" ,"),
    Rule("title_word", r"\p{Lu}\p{Ll}+"),
)


@query("rule_hits", "\nUNION ALL\n".join(
    f"SELECT '{r.rule_id}' AS rule_id, "
    f"CAST(sum(len(regexp_extract_all(text, '{r.pattern}'))) AS BIGINT) AS n_hits, "
    f"count(*) FILTER (WHERE regexp_matches(text, '{r.pattern}')) AS n_docs FROM documents" for r in AUDIT_RULES))
def hits_per_rule(spark: SparkSession, sf: str) -> DataFrame:
    return rule_hits(documents(spark, sf), AUDIT_RULES)


EDIT_TABLE = (
    ("dollar_run", 1, "literal", "$$$", "", None),
    ("licence_head", 2, "regex", r"(?m)^Released under ", "LICENCE: ", None),
    ("licence_tail", 3, "regex", r"LICENCE: the ([A-Z]+) License", "LICENCE: $1", None),
    ("licence_lines", 5, "section", "LICENCE: ", "TERMS", "\n"),
    ("terms", 6, "literal", "TERMS", "terms", None),
    ("never", 7, "literal", "no such text anywhere", "x", None),
)


def edit_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(EDIT_TABLE), EDITS)


@query("edit_table_hits", r"""
WITH e0 AS (SELECT text AS t FROM documents),
e1 AS (SELECT len(regexp_extract_all(t, '\$\$\$')) AS h0, replace(t, '$$$', '') AS t FROM e0),
e2 AS (SELECT h0, len(regexp_extract_all(t, '(?m)^Released under ')) AS h1,
              regexp_replace(t, '(?m)^Released under ', 'LICENCE: ', 'g') AS t FROM e1),
e3 AS (SELECT h0, h1, len(regexp_extract_all(t, 'LICENCE: the ([A-Z]+) License')) AS h2,
              regexp_replace(t, 'LICENCE: the ([A-Z]+) License', 'LICENCE: \1', 'g') AS t FROM e2),
c5 AS (SELECT h0, h1, h2, t, position('LICENCE: ' IN t) AS b FROM e3),
d5 AS (SELECT *, position(chr(10) IN t[b:]) AS w FROM c5),
e5 AS (SELECT h0, h1, h2, CAST(b > 0 AND w > 0 AS INT) AS h5,
              CASE WHEN b > 0 AND w > 0 THEN t[:b - 1] || 'TERMS' || chr(10) || chr(10) || t[b + w - 1:] ELSE t END AS t FROM d5),
s AS (SELECT sum(h0) AS h0, sum(h1) AS h1, sum(h2) AS h2, sum(h5) AS h5,
             sum(len(regexp_extract_all(t, 'TERMS'))) AS h6, sum(len(regexp_extract_all(t, 'no such text anywhere'))) AS h3 FROM e5)
SELECT rule_id, CAST(n AS BIGINT) AS n_hits, CAST(n > 0 AS INT) AS used FROM (
  SELECT 'dollar_run' AS rule_id, h0 AS n FROM s UNION ALL SELECT 'licence_head', h1 FROM s
  UNION ALL SELECT 'licence_tail', h2 FROM s UNION ALL SELECT 'never', h3 FROM s
  UNION ALL SELECT 'licence_lines', h5 FROM s UNION ALL SELECT 'terms', h6 FROM s)""")
def edit_table_hits(spark: SparkSession, sf: str) -> DataFrame:
    rules = edit_table(spark)
    return edit_counts(apply_edits(documents(spark, sf), rules), rules)


@query("error_summary", f"""
WITH {EV}, a AS (SELECT *, max(CAST(kind = 'error' AS INT)) OVER (PARTITION BY doc) AS has FROM ev),
e AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY pos DESC) AS n FROM a WHERE kind = 'error' OR has = 0)
SELECT doc, pos, text, CAST(kind = 'error' AS INT) AS is_error FROM e WHERE n <= CASE WHEN has = 1 THEN 15 ELSE 20 END""")
def error_summary(spark: SparkSession, sf: str) -> DataFrame:
    return au.error_summary(ev(spark, sf), ["doc"], kind("error")).select("doc", "pos", "text", "is_error")


@query("error_histogram", """
SELECT strftime(ts, '%H') || 'h' AS message, count(*) AS n FROM events WHERE event_type = 'error'
GROUP BY 1 ORDER BY n DESC, message""")
def error_histogram(spark: SparkSession, sf: str) -> DataFrame:
    errors = table(spark, sf, "events").filter("event_type = 'error'")
    return au.error_histogram(errors, F.concat(F.date_format("ts", "HH"), F.lit("h")))


# -- residual language -----------------------------------------------------------

# Letters of the other languages, which none of a language's own words have.
LETTERS = {"en": "[äöüßñçéèêáíóú]", "fr": "[äöüßñ]", "de": "[ñçéèê]", "es": "[äöüßçèê]"}
DETECTORS = {
    lang: re_.Detector(
        markers=d.markers, letters=LETTERS[lang], script=r"\p{L}",
        caption_prefix=r"^(?:Licensed|Released)", short_prefix=r"^\p{Lu}\p{L}*\.$")
    for lang, d in re_.foreign_detectors(MARKERS).items()
}


def residual_flag(line="line", lang="lang"):
    return re_.per_language(lang, lambda c: re_.needs_residual(line, DETECTORS[c]), list(DETECTORS), F.lit(False))


def sql_residual(line: str, lang: str) -> str:
    """The same ladder in SQL."""
    cases = []
    for code, d in DETECTORS.items():
        hits, strong = sql_hits(line, d.markers), f"regexp_matches({line}, '{d.letters}')"
        cases.append(f"""WHEN {lang} = '{code}' THEN CASE
          WHEN length({line}) >= 80 THEN {hits} >= 2 OR {strong}
          WHEN length({line}) >= 35 AND {hits} >= 2 THEN true
          WHEN (starts_with({line}, '#') OR regexp_matches({line}, '{d.caption_prefix}')) AND regexp_matches({line}, '\\p{{L}}')
            THEN {hits} >= 1 OR {strong}
          WHEN length({line}) >= 8 AND regexp_matches({line}, '{d.short_prefix}')
            THEN {strong} OR (regexp_matches({line}, '\\p{{L}}') AND {hits} >= 1)
          ELSE false END""")
    return f"CASE {' '.join(cases)} ELSE false END"


@query("marker_hits", "SELECT doc_id, " + ", ".join(
    f"CAST({sql_hits('text', ms)} AS INT) AS {lang}" for lang, ms in MARKERS.items()) + " FROM documents")
def marker_hits(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", *[
        re_.marker_hits("text", ms).alias(lang) for lang, ms in MARKERS.items()])


RESIDUAL = f"{LN}, res AS (SELECT *, {sql_residual('trim(line)', 'lang')} AS flag FROM ln)"


@query("residual_lines", f"WITH {RESIDUAL} SELECT doc_id, line_no, lang FROM res WHERE flag")
def residual_lines(spark: SparkSession, sf: str) -> DataFrame:
    return ln(spark, sf, "lang").filter(residual_flag()).select("doc_id", "line_no", "lang")


@query("residual_docs", f"WITH {RESIDUAL} SELECT doc_id, count(*) AS n_blocks FROM res WHERE flag GROUP BY doc_id")
def residual_docs(spark: SparkSession, sf: str) -> DataFrame:
    return re_.residual_documents(ln(spark, sf, "lang"), residual_flag(), ["doc_id"])


@query("residual_by_source", f"""
WITH {RESIDUAL}, s AS (SELECT source, count(*) AS n_lines, count(*) FILTER (WHERE flag) AS n_residual FROM res GROUP BY source)
SELECT *, CAST(rank() OVER (ORDER BY n_residual DESC) AS INT) AS rnk FROM s""")
def residual_by_source(spark: SparkSession, sf: str) -> DataFrame:
    flagged = ln(spark, sf, "lang", "source").select("source", residual_flag().alias("flag"))
    counts = flagged.groupBy("source").agg(
        F.count("*").alias("n_lines"), F.count_if("flag").alias("n_residual"))
    return au.ranked(counts, "n_residual")
