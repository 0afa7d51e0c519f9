"""Reading, splitting, classifying, masking and chunking of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.catalog.base import EV, LN, SP, documents, ev, kind, ln, query, sql_mask, sql_unmask, table
from corpusprep.functions import text as tx
from corpusprep.operators import blocks as bl
from corpusprep.operators import sequence as sq
from corpusprep.operators.concat import concat_ordered, positioned
from corpusprep.operators.lookup import bounded
from corpusprep.operators.packing import chunk_text, fixed_chunks, pack_batches, split_in_order
from corpusprep.operators.spans import leak_scan, mask_spans, restore_unresolved, span_table, unmask
from corpusprep.sources.readers import with_suffix
from corpusprep.operators.audit import required


@query("corpus_scan", """
SELECT doc_id, CAST(len(string_split(text, chr(10))) AS INT) AS n_lines,
       CAST(length(text) AS INT) AS n_chars
FROM documents""")
def corpus_scan(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", F.size(tx.lines("text")).alias("n_lines"), F.length("text").alias("n_chars"))


@query("asset_scan", r"""
SELECT DISTINCT url AS path FROM pages
WHERE regexp_extract(lower(url), '(\.[^./]*)$', 1) IN ('.html', '.htm')""")
def asset_scan(spark: SparkSession, sf: str) -> DataFrame:
    files = table(spark, sf, "pages").select(F.col("url").alias("path")).distinct()
    return with_suffix(files, "path", (".html", ".htm"))


CONCAT_PART = 4000


@query("concat_ordered", f"""
SELECT conv_id, part, CAST(count(*) AS INT) AS n_blocks,
       string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text
FROM (SELECT conv_id, turn, text, CAST(floor(coalesce(sum(length(text) + 2) OVER (
        PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        / {CONCAT_PART}) AS INT) AS part
      FROM conversations)
GROUP BY conv_id, part""")
def concat_by_turn(spark: SparkSession, sf: str) -> DataFrame:
    return concat_ordered(table(spark, sf, "conversations"), ["conv_id"], "turn", part_chars=CONCAT_PART)


@query("merge_selected", f"""
WITH chosen AS (SELECT DISTINCT conv_id FROM conversations WHERE role = 'system'),
parts AS (
  SELECT conv_id, turn, text, CAST(floor(coalesce(sum(length(text) + 2) OVER (
           ORDER BY conv_id DESC, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           / {CONCAT_PART}) AS INT) AS part
  FROM conversations JOIN chosen USING (conv_id))
SELECT 'merged' AS target, part, CAST(count(*) AS INT) AS n_blocks,
       string_agg(text, chr(10) || chr(10) ORDER BY conv_id DESC, turn) AS text
FROM parts GROUP BY part""")
def merge_selected(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    # The caller's order: newest conversation first.
    names = turns.filter("role = 'system'").select("conv_id").distinct().withColumn(
        "ord", -F.col("conv_id"))
    checked = required(turns, names, ["conv_id"])
    rows = turns.join(bounded(checked), "conv_id").select(
        F.lit("merged").alias("target"), "text", "ord", "turn")
    rows = positioned(rows, ["ord", "turn"], "at")
    return concat_ordered(rows, ["target"], "at", part_chars=CONCAT_PART)


LINE_KINDS = (
    ("heading", r"^[\p{Lu}0-9\s.,]+$"),
    ("table", r" \| "),
    ("licence", r"(?:licensed|Licensed|Released) under "),
)


@query("classify_lines", rf"""
WITH {LN}
SELECT doc_id, CASE WHEN regexp_matches(line, '{LINE_KINDS[0][1]}') THEN 'heading'
                    WHEN regexp_matches(line, '{LINE_KINDS[1][1]}') THEN 'table'
                    WHEN regexp_matches(line, '{LINE_KINDS[2][1]}') THEN 'licence'
                    ELSE 'prose' END AS kind,
       count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars
FROM ln GROUP BY ALL""")
def classify_lines(spark: SparkSession, sf: str) -> DataFrame:
    typed = ln(spark, sf).withColumn("kind", bl.classify("line", LINE_KINDS))
    return typed.groupBy("doc_id", "kind").agg(
        F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


NUMBER_LINE = r"^\(?\d+(?:\.\d+)?\)?$"
SYMBOLS = r"\$\$\$|%%%|###|&&&|\*\*\*|[0-9]{4,}"
SECRET = r'token = "[0-9a-f]*"'
LONG_WORD = r"\p{L}{14,}"


def symbol_rule(line):
    return bl.symbol_line(line, symbol=SYMBOLS, exempt=(NUMBER_LINE,), ignore=(SECRET,), prose=LONG_WORD)


SYMBOL_SQL = rf"""(length(trim(line)) > 0 AND NOT regexp_matches(trim(line), '{NUMBER_LINE}')
  AND NOT regexp_matches(regexp_replace(trim(line), '{SECRET}', '', 'g'), '{LONG_WORD}')
  AND regexp_matches(line, '{SYMBOLS}'))"""


@query("symbol_lines", f"""
WITH {LN}
SELECT doc_id, line_no, CAST(length(line) AS INT) AS n_chars FROM ln WHERE {SYMBOL_SQL}""")
def symbol_lines(spark: SparkSession, sf: str) -> DataFrame:
    return ln(spark, sf).filter(symbol_rule("line")).select(
        "doc_id", "line_no", F.length("line").alias("n_chars"))


@query("block_routing", f"""
WITH {LN}, counted AS (
  SELECT doc_id, CAST(count(*) FILTER (WHERE {SYMBOL_SQL}) AS INT) AS n_hits,
         CAST(count(*) FILTER (WHERE length(trim(line)) > 0) AS INT) AS n_lines
  FROM ln GROUP BY doc_id)
SELECT *, CASE WHEN n_hits = 0 THEN 'none' WHEN n_hits = n_lines THEN 'all' ELSE 'mixed' END AS route
FROM counted""")
def block_routing(spark: SparkSession, sf: str) -> DataFrame:
    # Lines stay in their document's row: counting them needs no shuffle.
    filled = F.filter(tx.lines("text"), lambda x: F.length(tx.strip(x)) > 0)
    counted = documents(spark, sf).select("doc_id", filled.alias("ls")).select(
        "doc_id", F.size(F.filter("ls", symbol_rule)).alias("n_hits"), F.size("ls").alias("n_lines"))
    return counted.withColumn("route", bl.route(F.col("n_hits"), F.col("n_lines")))


def _sql_count(pattern: str) -> str:
    return f"len(regexp_extract_all(text, '{pattern}'))"


@query("malformed_audit", rf"""
WITH flags AS (SELECT
  count(*) FILTER (WHERE regexp_matches(text, 'MATHBLK|MATHINL|HIDE')) AS leaked_token,
  count(*) FILTER (WHERE regexp_matches(text, '\\\p{{Cyrillic}}+')) AS foreign_command,
  count(*) FILTER (WHERE contains(text, '\begin{{array}}') AND trim(regexp_replace(text,
    '\\begin\{{array\}}\{{[^\}}]*\}}|\\end\{{array\}}', '', 'g')) = '') AS empty_array,
  count(*) FILTER (WHERE regexp_matches(text, '^\s*\\begin\{{[A-Za-z*]+\}}\s*$')) AS lone_begin,
  count(*) FILTER (WHERE regexp_matches(text, '(?m)^\s*(?:#|- |\d+\.)')) AS list_or_heading,
  count(*) FILTER (WHERE {_sql_count('[{]')} <> {_sql_count('[}]')}) AS brace_imbalance,
  count(*) FILTER (WHERE list_sort(regexp_extract_all(text, '\\begin\{{([A-Za-z*]+)\}}', 1))
    <> list_sort(regexp_extract_all(text, '\\end\{{([A-Za-z*]+)\}}', 1))) AS environment_imbalance,
  count(*) FILTER (WHERE {_sql_count('[(]')} <> {_sql_count('[)]')}) AS paren_imbalance,
  count(*) FILTER (WHERE {_sql_count('"')} % 2 = 1) AS odd_quotes,
  count(*) FILTER (WHERE {_sql_count(r'[$%#&*]{3}')} > 20) AS symbol_storm
  FROM documents)
SELECT flag, n FROM (UNPIVOT flags ON COLUMNS(*) INTO NAME flag VALUE n)""")
def malformed_audit(spark: SparkSession, sf: str) -> DataFrame:
    def n(pattern):
        return tx.count_matches("text", pattern)

    flags = {
        **bl.malformed_flags("text"),
        "paren_imbalance": n(r"\(") != n(r"\)"),
        "odd_quotes": n('"') % 2 == 1,
        "symbol_storm": n(r"[$%#&*]{3}") > 20,
    }
    return bl.flag_counts(documents(spark, sf), flags)


RISKY, GLUED = r"\$\$\$|%%%", r"\p{L}&&&"


@query("unsafe_lines", rf"""
WITH {LN}, body AS (SELECT doc_id, trim(line) AS line,
  trim(regexp_replace(trim(line), '^(?:[-*+]|\d+\.)\s+', '')) AS body FROM ln)
SELECT doc_id, CAST(count(*) AS INT) AS n_unsafe FROM body
WHERE length(body) > 0 AND NOT regexp_matches(line, '^(?:#|>)') AND NOT regexp_matches(body, '^`.*`$')
  AND (regexp_matches(body, '{RISKY}') OR regexp_matches(body, '{GLUED}'))
GROUP BY doc_id""")
def unsafe_lines(spark: SparkSession, sf: str) -> DataFrame:
    def unsafe(line):
        return bl.unsafe_line(line, RISKY, GLUED, exempt=r"^(?:#|>)")

    hits = F.size(F.filter(tx.lines("text"), unsafe))
    return documents(spark, sf).select("doc_id", hits.alias("n_unsafe")).filter("n_unsafe > 0")


@query("unsafe_outside_code", rf"""
WITH {LN}, f AS (SELECT doc_id, line_no, line, contains(line, ' | ') AS fence FROM ln),
s AS (SELECT *, coalesce(sum(CAST(fence AS INT)) OVER (PARTITION BY doc_id ORDER BY line_no
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 AS in_code FROM f)
SELECT doc_id, line_no FROM s WHERE NOT fence AND in_code = 0 AND regexp_matches(line, '{RISKY}')""")
def unsafe_outside_code(spark: SparkSession, sf: str) -> DataFrame:
    risky = F.col("line").rlike(RISKY)
    fence = F.col("line").contains(" | ")
    found = sq.unsafe_outside_code(ln(spark, sf), ["doc_id"], risky, fence, "line_no")
    return found.select("doc_id", "line_no")


VERSION = r"[Vv]ersion ([0-9]{1,3})"


@query("marked_pages", f"""
WITH {LN}, m AS (SELECT doc_id, line_no, regexp_extract_all(line, '{VERSION}', 1) AS p FROM ln)
SELECT doc_id, line_no, array_to_string(p, ',') AS pages, CAST(p[1] AS INT) AS page FROM m WHERE len(p) > 0""")
def marked_pages(spark: SparkSession, sf: str) -> DataFrame:
    marked = bl.mark_pages(ln(spark, sf), VERSION, "line").filter(F.size("pages") > 0)
    shown = F.array_join(F.transform("pages", lambda p: p.cast("string")), ",")
    return marked.select("doc_id", "line_no", shown.alias("pages"), "page")


@query("edit_literal", """
WITH a AS (SELECT doc_id, text, strpos(text, ' the ') AS i FROM documents),
b AS (SELECT *, CASE WHEN i > 0 AND strpos(substr(text, i), '.') > 0 THEN i - 1 + strpos(substr(text, i), '.') ELSE 0 END AS j FROM a)
SELECT doc_id, CASE WHEN i > 0 AND j > i THEN substr(text, 1, i - 1) || '[cut]' || chr(10) || chr(10) || substr(text, j)
       ELSE text END AS edited FROM b""")
def edit_literal(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", bl.edit_literal("text", " the ", ".", "[cut] ").alias("edited"))


@query("split_join", f"""
WITH b AS (SELECT doc_id, trim(s, ' ' || chr(10) || chr(9) || chr(13)) AS s, i FROM (
  SELECT doc_id, ss[i] AS s, i FROM (SELECT doc_id, ss, unnest(range(1, len(ss) + 1)) AS i FROM (
    SELECT doc_id, string_split_regex(text, '\\.\\s*\\n\\s*') AS ss FROM documents))))
SELECT doc_id, CAST(count(*) AS INT) AS n_blocks,
       string_agg(s, chr(10) || chr(10) ORDER BY i) || chr(10) AS text
FROM b WHERE s <> '' GROUP BY doc_id""")
def split_join(spark: SparkSession, sf: str) -> DataFrame:
    parts = F.split("text", r"\.\s*\n\s*", -1)
    split = documents(spark, sf).select("doc_id", parts.alias("parts"))
    filled = F.filter("parts", lambda s: F.length(tx.strip(s)) > 0)
    return split.select("doc_id", F.size(filled).alias("n_blocks"), bl.joined(F.col("parts")).alias("text"))


# -- spans --------------------------------------------------------------------

MASKED = sql_mask("m", "documents", ["doc_id", "lang", "source", "text"])


def masked(spark: SparkSession, sf: str) -> DataFrame:
    return mask_spans(documents(spark, sf), SP)


@query("mask_spans", f"WITH {MASKED}\n" + "\nUNION ALL\n".join(
    f"SELECT doc_id, '{k.name}' AS kind, CAST(i - 1 AS INT) AS idx, "
    f"'{k.prefix}' || format('{{:04d}}', i - 1) || 'X' AS placeholder, s_{k.name}[i] AS original "
    f"FROM (SELECT doc_id, s_{k.name}, unnest(range(1, len(s_{k.name}) + 1)) AS i FROM m)" for k in SP))
def mask_table(spark: SparkSession, sf: str) -> DataFrame:
    return span_table(masked(spark, sf), SP, ["doc_id"])


@query("masked_text", f"WITH {MASKED} SELECT doc_id, masked FROM m")
def masked_text(spark: SparkSession, sf: str) -> DataFrame:
    return masked(spark, sf).select("doc_id", "masked")


@query("span_counts", f"""
WITH {MASKED} SELECT doc_id, {', '.join(f'CAST(len(s_{k.name}) AS INT) AS {k.name}' for k in SP)}
FROM m WHERE {' + '.join(f'len(s_{k.name})' for k in SP)} > 0""")
def span_counts(spark: SparkSession, sf: str) -> DataFrame:
    sizes = masked(spark, sf).select("doc_id", *[F.size(F.col("spans")[k.name]).alias(k.name) for k in SP])
    return sizes.filter(sum((F.col(k.name) for k in SP), F.lit(0)) > 0)


@query("mask_roundtrip", f"""
WITH {MASKED}, {sql_unmask('u', 'm')}
SELECT doc_id, CAST(length(masked) AS INT) AS n_masked, restored,
       CAST(regexp_replace(restored, '\\s', '', 'g') = regexp_replace(text, '\\s', '', 'g') AS INT) AS same_text
FROM u""")
def mask_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    back = unmask(masked(spark, sf), SP)

    def bare(c):
        return F.replace(F.replace(c, F.lit(" ")), F.lit("\n"))

    return back.select("doc_id", F.length("masked").alias("n_masked"), "restored",
                       (bare("restored") == bare("text")).cast("int").alias("same_text"))


@query("placeholder_leaks", f"""
WITH {MASKED}, {sql_unmask('u', 'm')}
""" + "\nUNION ALL\n".join(
    f"SELECT '{stage}' AS stage, '{k.name}' AS kind, "
    f"CAST(coalesce(sum(len(regexp_extract_all({stage}, '{k.token}'))), 0) AS BIGINT) AS n_tokens, "
    f"count(*) FILTER (WHERE regexp_matches({stage}, '{k.token}')) AS n_docs FROM u"
    for stage in ("masked", "restored") for k in SP))
def placeholder_leaks(spark: SparkSession, sf: str) -> DataFrame:
    return leak_scan(unmask(masked(spark, sf), SP), SP, ("masked", "restored"))


@query("restore_unresolved", f"""
WITH {MASKED}, n AS (SELECT doc_id, {' + '.join(f'len(s_{k.name})' for k in SP)} AS n FROM m)
SELECT doc_id, CAST(CASE WHEN l.doc_id IS NULL THEN 0 ELSE n END AS INT) AS n_restored,
       CAST(CASE WHEN l.doc_id IS NULL THEN n ELSE 0 END AS INT) AS n_missing
FROM n LEFT JOIN labels l USING (doc_id) WHERE n > 0""")
def heal_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    known = docs.join(table(spark, sf, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    leaked = masked(spark, sf).select("doc_id", F.col("masked").alias("text"))
    healed = restore_unresolved(leaked, known, SP, ["doc_id"])
    return healed.select("doc_id", "n_restored", F.size("missing").alias("n_missing")).filter(
        "n_restored + n_missing > 0")


# -- chunks and batches ---------------------------------------------------------

CUT = 1000


@query("chunk_text", f"""
WITH RECURSIVE cuts AS (
  SELECT doc_id, text, 0 AS chunk_no, CAST(0 AS BIGINT) AS s,
         CASE WHEN length(text) <= {CUT} THEN length(text) ELSE NULL END AS e0
  FROM documents
  UNION ALL
  SELECT doc_id, text, chunk_no + 1, e, NULL FROM (
    SELECT doc_id, text, chunk_no, CASE WHEN length(text) - s <= {CUT} THEN length(text) ELSE
      s + CASE WHEN nl >= 2 THEN nl ELSE {CUT} END END AS e
    FROM (SELECT *, CASE WHEN contains(w, chr(10)) THEN {CUT} + 1 - instr(reverse(w), chr(10)) ELSE 0 END AS nl
          FROM (SELECT *, text[s + 1:s + {CUT}] AS w FROM cuts))) WHERE e < length(text)),
ends AS (SELECT doc_id, text, chunk_no, s, coalesce(lead(s) OVER (PARTITION BY doc_id ORDER BY chunk_no), length(text)) AS e FROM cuts)
SELECT doc_id, CAST(chunk_no AS INT) AS chunk_no, text[s + 1:e] AS chunk FROM ends""")
def chunk_documents(spark: SparkSession, sf: str) -> DataFrame:
    return chunk_text(documents(spark, sf), limit=CUT)


@query("pack_batches", f"""
WITH RECURSIVE {EV}, o AS (
  SELECT doc, pos, length(text) + 32 AS w, row_number() OVER (PARTITION BY doc ORDER BY pos) AS rn FROM ev),
walk AS (
  SELECT doc, pos, rn, w AS fill, CAST(0 AS BIGINT) AS batch FROM o WHERE rn = 1
  UNION ALL
  SELECT o.doc, o.pos, o.rn, CASE WHEN fill + w > 600 THEN w ELSE fill + w END,
         batch + CASE WHEN fill + w > 600 THEN 1 ELSE 0 END
  FROM walk JOIN o ON o.doc = walk.doc AND o.rn = walk.rn + 1)
SELECT doc, pos, batch FROM walk""")
def pack_events(spark: SparkSession, sf: str) -> DataFrame:
    return pack_batches(ev(spark, sf), ["doc"], F.length("text"), limit=600)


@query("fixed_chunks", """
SELECT source, doc_id, CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 50 + 1 AS BIGINT) AS chunk_no
FROM documents""")
def fixed_document_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return fixed_chunks(table(spark, sf, "documents").select("source", "doc_id"), ["source"], "doc_id")


@query("split_in_order", f"""
WITH RECURSIVE {EV}, l AS (
  SELECT doc, page, row_number() OVER (PARTITION BY doc ORDER BY pos) - 1 AS i,
         kind = 'signup' AS h, kind = 'error' AS b FROM ev),
m AS (SELECT doc, page, i,
        list(CASE WHEN h THEN i END) OVER w AS hs, list(CASE WHEN b THEN i END) OVER w AS bs
      FROM l WINDOW w AS (PARTITION BY doc ORDER BY i ROWS BETWEEN 120 PRECEDING AND CURRENT ROW)),
k AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY i) AS n FROM m WHERE page IS NOT NULL),
walk AS (
  SELECT doc, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS start, 10 AS bound, CAST(NULL AS BIGINT) AS cut
  FROM (SELECT DISTINCT doc FROM l)
  UNION ALL
  SELECT doc, n, coalesce(cut, start), CASE WHEN cut IS NULL THEN bound ELSE bound + 10 END, cut FROM (
    SELECT k.doc, k.n, start, bound, CASE WHEN k.page < bound THEN NULL ELSE coalesce(
      list_max(list_filter(hs, lambda x: x > start + 3)),
      list_max(list_filter(bs, lambda x: x + 1 > start + 3 AND x > start)) + 1, k.i) END AS cut
    FROM walk JOIN k ON k.doc = walk.doc AND k.n = walk.n + 1)),
starts AS (
  SELECT doc, CAST(0 AS BIGINT) AS first_line, 0 AS start_page FROM (SELECT DISTINCT doc FROM l)
  UNION ALL SELECT doc, start, bound - 10 FROM walk WHERE cut IS NOT NULL),
sizes AS (SELECT doc, count(*) AS n, coalesce(max(page), 0) AS mx FROM l GROUP BY doc),
pieces AS (
  SELECT doc, start_page, first_line, n, mx,
         lead(first_line) OVER (PARTITION BY doc ORDER BY start_page) AS nxt FROM starts JOIN sizes USING (doc))
SELECT doc, start_page, CAST(CASE WHEN nxt IS NULL AND mx >= start_page THEN mx ELSE start_page + 9 END AS INT) AS end_page,
       first_line, CAST(coalesce(nxt, n) - first_line AS BIGINT) AS n_lines
FROM pieces WHERE coalesce(nxt, n) > first_line""")
def split_events(spark: SparkSession, sf: str) -> DataFrame:
    return split_in_order(ev(spark, sf), ["doc"], kind("signup"), kind("error"), width=10)
