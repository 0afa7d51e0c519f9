"""Ordered-block operators on the event blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.catalog.base import EV, ev, kind, query, table, with_pages
from corpusprep.operators import intervals as iv
from corpusprep.operators import sequence as sq
from corpusprep.operators.blocks import drop_contaminated
from corpusprep.operators.rules import Rule
from corpusprep.plans.export import export_chunks
from corpusprep.plans.lifecycle import export_lifecycle
from corpusprep.session import shared_dir
from corpusprep.sources.writers import chunk_manifest, write_chunks

DOC = ["doc"]
PART = 400

INHERIT = """inh AS (
  SELECT *, coalesce(last_value(page IGNORE NULLS) OVER (PARTITION BY doc ORDER BY pos), 0) AS eff_page FROM ev)"""


@query("inherit_page", f"WITH {EV}, {INHERIT} SELECT doc, pos, eff_page FROM inh")
def inherit_page(spark: SparkSession, sf: str) -> DataFrame:
    return sq.inherit_page(ev(spark, sf), DOC).select("doc", "pos", "eff_page")


CHUNKS = f"""{EV}, {INHERIT},
parts AS (SELECT doc, eff_page - eff_page % 10 AS start_page, pos, text,
    CAST(floor(coalesce(sum(length(text) + 2) OVER (PARTITION BY doc, eff_page - eff_page % 10 ORDER BY pos
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / {PART}) AS INT) AS part FROM inh),
ends AS (SELECT doc, coalesce(max(page), 0) AS mx FROM ev GROUP BY doc),
chunks AS (SELECT doc, start_page, CAST(least(start_page + 9, mx) AS INT) AS end_page, part,
    CAST(count(*) AS INT) AS n_blocks, string_agg(text, chr(10) || chr(10) ORDER BY pos) AS text
  FROM parts JOIN ends USING (doc) GROUP BY doc, start_page, mx, part)"""


@query("page_buckets", f"WITH {CHUNKS} SELECT * FROM chunks")
def page_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return sq.page_chunks(with_pages(ev(spark, sf)), DOC, width=10, part_chars=PART)


@query("chunk_manifest", f"""
WITH {CHUNKS}, u AS (SELECT DISTINCT doc, start_page, end_page FROM chunks)
SELECT doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY start_page) AS BIGINT) AS idx,
       format('{{:03d}}-{{:03d}}', start_page, end_page) AS page_range,
       CASE WHEN (doc + start_page) % 4 = 0 THEN 'FAILED' ELSE 'OK' END AS status,
       'doc' || doc || '_p' || format('{{:03d}}-{{:03d}}', start_page, end_page) || '.md' AS name,
       CASE WHEN (doc + start_page) % 4 = 0 THEN 'build ' || doc || ' stopped' END AS error
FROM u""")
def manifest(spark: SparkSession, sf: str) -> DataFrame:
    chunks = sq.page_chunks(with_pages(ev(spark, sf)), DOC, width=10)
    failed = F.when((F.col("doc") + F.col("start_page")) % 4 == 0, F.format_string("build %d stopped", "doc"))
    builds = chunks.select("doc", "start_page", failed.alias("error")).distinct()
    return chunk_manifest(chunks, DOC, builds=builds)


@query("written_chunks", f"WITH {CHUNKS} SELECT doc, start_page, end_page, part, n_blocks, text FROM chunks")
def written_chunks(spark: SparkSession, sf: str) -> DataFrame:
    chunks = sq.page_chunks(with_pages(ev(spark, sf)), DOC, width=10, part_chars=PART)
    folder = shared_dir(spark, "chunks")
    write_chunks(chunks, folder, DOC)
    return spark.read.schema(chunks.schema).parquet(folder).select(
        "doc", "start_page", "end_page", "part", "n_blocks", "text")


MONOTONE = """mx AS (
  SELECT *, max(page) OVER (PARTITION BY doc ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx FROM ev),
fl AS (SELECT *, CASE WHEN page IS NULL THEN NULL WHEN page < mx - 10 THEN 0 ELSE 1 END AS f FROM mx),
mono AS (SELECT *, coalesce(last_value(f IGNORE NULLS) OVER (PARTITION BY doc ORDER BY pos), 1) AS keep FROM fl)"""


@query("monotone_filter", f"WITH {EV}, {MONOTONE} SELECT doc, pos, page FROM mono WHERE keep = 1")
def monotone_filter(spark: SparkSession, sf: str) -> DataFrame:
    return sq.monotone_filter(ev(spark, sf), DOC).select("doc", "pos", "page")


@query("window_filter", f"""
WITH {EV}, a AS (SELECT *, CASE WHEN page IS NOT NULL THEN CAST(page BETWEEN 20 AND 40 AS INT) END AS i FROM ev),
b AS (SELECT *, max(i) OVER w AS seen, last_value(i IGNORE NULLS) OVER w AS lm FROM a
      WINDOW w AS (PARTITION BY doc ORDER BY pos ROWS UNBOUNDED PRECEDING))
SELECT doc, pos, page FROM b WHERE i = 1 OR (i IS NULL AND (coalesce(seen, 0) = 0 OR lm = 1))""")
def window_filter(spark: SparkSession, sf: str) -> DataFrame:
    return sq.window_filter(
        with_pages(ev(spark, sf)), DOC, F.lit(20), F.lit(40), tolerance=0).select("doc", "pos", "page")


@query("drop_sections", f"""
WITH {EV}, a AS (SELECT *, last_value(CASE kind WHEN 'error' THEN 1 WHEN 'signup' THEN 0 END IGNORE NULLS)
                 OVER (PARTITION BY doc ORDER BY pos) AS skip FROM ev)
SELECT doc, pos, kind FROM a WHERE coalesce(skip, 0) = 0""")
def drop_sections(spark: SparkSession, sf: str) -> DataFrame:
    return sq.drop_sections(ev(spark, sf), DOC, kind("error"), kind("signup")).select("doc", "pos", "kind")


@query("drop_contaminated", f"""
WITH {EV}, {INHERIT}
SELECT doc, pos, kind, eff_page - eff_page % 10 AS start_page FROM inh
WHERE NOT (eff_page - eff_page % 10 >= 50 AND kind = 'error')""")
def contaminated(spark: SparkSession, sf: str) -> DataFrame:
    bucketed = sq.page_buckets(with_pages(ev(spark, sf)), DOC, width=10)
    clean = drop_contaminated(bucketed, F.col("start_page"), kind("error"), from_page=50)
    return clean.select("doc", "pos", "kind", "start_page")


@query("page_asof", f"""
WITH {EV}, a AS (SELECT *, coalesce(max(page) OVER (PARTITION BY doc ORDER BY pos), 0) AS p FROM ev)
SELECT doc, pos AS off, p AS page_asof FROM a WHERE kind = 'error'""")
def page_asof(spark: SparkSession, sf: str) -> DataFrame:
    blocks = ev(spark, sf).withColumn("off", F.col("pos"))
    return sq.page_asof(blocks.filter(kind("error")), blocks.filter("page IS NOT NULL"), DOC)


@query("next_marker", f"""
WITH {EV}, a AS (SELECT *, min(CASE WHEN kind = 'purchase' THEN pos END) OVER (
    PARTITION BY doc ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM ev)
SELECT doc, pos AS off, nxt AS next_off FROM a WHERE kind = 'error'""")
def next_marker(spark: SparkSession, sf: str) -> DataFrame:
    blocks = ev(spark, sf).withColumn("off", F.col("pos"))
    return sq.next_marker(blocks.filter(kind("error")), blocks.filter(kind("purchase")), DOC)


TAIL = """seen AS (
  SELECT *, coalesce(max(page) OVER (PARTITION BY doc ORDER BY pos), 0) AS at_page,
         greatest(1, max(page) OVER (PARTITION BY doc) - 5) AS cut,
         max(pos) OVER (PARTITION BY doc) + 1 AS stop,
         min(CASE WHEN kind IN ('error', 'purchase', 'signup') THEN pos END) OVER f AS next_heading,
         min(CASE WHEN kind = 'signup' THEN pos END) OVER f AS next_matter
  FROM ev WINDOW f AS (PARTITION BY doc ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
late AS (SELECT * FROM seen WHERE at_page >= coalesce(cut, 0)),
tail AS (
  SELECT doc, pos AS s, coalesce(next_heading, stop) AS e, 'section' AS label FROM late WHERE kind = 'error'
  UNION ALL SELECT doc, pos, coalesce(next_matter, stop), 'appendix' FROM late WHERE kind = 'purchase'
  UNION ALL SELECT doc, min(pos), max(stop), 'tail' FROM late WHERE kind = 'signup' GROUP BY doc)"""


def _tail(spark: SparkSession, sf: str) -> DataFrame:
    return sq.tail_ranges(
        ev(spark, sf), DOC, kind("error"), kind("error", "purchase", "signup"), kind("purchase"),
        kind("signup"), margin=5)


@query("tail_ranges", f"WITH {EV}, {TAIL} SELECT doc, s, e, label FROM tail")
def tail_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return _tail(spark, sf)


@query("remove_ranges", f"""
WITH {EV}, {TAIL}
SELECT doc, pos, kind FROM ev WHERE NOT EXISTS (
  SELECT 1 FROM tail WHERE tail.doc = ev.doc AND tail.s <= ev.pos AND ev.pos < tail.e)""")
def remove_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return sq.remove_ranges(ev(spark, sf), _tail(spark, sf), DOC).select("doc", "pos", "kind")


@query("merge_ranges", """
WITH r AS (SELECT l_suppkey AS doc, date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS s,
                  date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) + CAST(l_quantity AS BIGINT) % 7 AS e,
                  l_returnflag AS label FROM lineitem),
o AS (SELECT *, max(e) OVER (PARTITION BY doc ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM r),
g AS (SELECT *, sum(CASE WHEN pe IS NULL OR s > pe THEN 1 ELSE 0 END) OVER (
        PARTITION BY doc ORDER BY s, e RANGE UNBOUNDED PRECEDING) AS island FROM o),
l AS (SELECT doc, island, label, min(s) AS s, max(e) AS e, count(*) AS n FROM g GROUP BY ALL)
SELECT doc, CAST(min(s) AS BIGINT) AS s, CAST(max(e) AS BIGINT) AS e, CAST(sum(n) AS BIGINT) AS n_ranges,
       string_agg(label || ':' || n, ',' ORDER BY s, label) AS labels
FROM l GROUP BY doc, island""")
def merge_ranges(spark: SparkSession, sf: str) -> DataFrame:
    merged = sq.merge_ranges(deliveries(spark, sf), DOC)
    shown = F.transform("labels", lambda x: F.concat_ws(":", x["label"], x["n"].cast("string")))
    return merged.withColumn("labels", F.array_join(shown, ","))


def deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges of days per supplier."""
    day = F.date_diff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("bigint")
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("doc"), day.alias("s"),
        (day + F.col("l_quantity").cast("bigint") % 7).alias("e"), F.col("l_returnflag").alias("label"))


LABEL_PART = 50


@query("merged_labels", f"""
WITH r AS (SELECT l_suppkey AS doc, date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS s,
                  date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) + CAST(l_quantity AS BIGINT) % 7 AS e,
                  l_returnflag AS label FROM lineitem),
c AS (SELECT doc, s, e, label, count(*) AS n FROM r GROUP BY ALL),
o AS (SELECT *, max(e) OVER (PARTITION BY doc ORDER BY s, e, label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM c),
g AS (SELECT *, sum(CASE WHEN pe IS NULL OR s > pe THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY s, e, label) AS island FROM o),
i AS (SELECT *, min(s) OVER (PARTITION BY doc, island) AS first,
             (row_number() OVER (PARTITION BY doc, island ORDER BY s, e, label) - 1) // {LABEL_PART} AS part FROM g)
SELECT doc, CAST(first AS BIGINT) AS s, CAST(part AS INT) AS part, string_agg(label || n, ' ' ORDER BY i.s, i.e, i.label) AS labels
FROM i GROUP BY doc, first, part""")
def merged_labels(spark: SparkSession, sf: str) -> DataFrame:
    """All labels of a merged range, in the order of its ranges."""
    parts = iv.merged_labels(deliveries(spark, sf), DOC, LABEL_PART)
    shown = F.transform("ranges", lambda x: F.concat(x["label"], x["n"].cast("string")))
    return parts.select("doc", "s", "part", F.array_join(shown, " ").alias("labels"))


@query("dedupe_refs", f"""
WITH {EV}, a AS (SELECT *, row_number() OVER (PARTITION BY doc, page, kind = 'view' ORDER BY pos) AS n FROM ev)
SELECT doc, pos, kind, page FROM a WHERE kind <> 'view' OR n = 1""")
def dedupe_refs(spark: SparkSession, sf: str) -> DataFrame:
    # Views stand alone; clicks refer to a page inside prose and are left as they are.
    ref = F.when(kind("view"), F.col("page"))
    return sq.dedupe_refs(ev(spark, sf), DOC, ref).select("doc", "pos", "kind", "page")


CAPTIONS = """ahead AS (
  SELECT *, CASE WHEN kind = 'view' THEN '' ELSE text END AS line, kind = 'error' AS stop FROM ev),
looked AS (SELECT *, [{'t': lead(line, 1) OVER w, 's': lead(stop, 1) OVER w},
                      {'t': lead(line, 2) OVER w, 's': lead(stop, 2) OVER w},
                      {'t': lead(line, 3) OVER w, 's': lead(stop, 3) OVER w},
                      {'t': lead(line, 4) OVER w, 's': lead(stop, 4) OVER w}] AS nx
           FROM ahead WINDOW w AS (PARTITION BY doc ORDER BY pos)),
firsts AS (SELECT doc, pos, text, list_filter(nx, lambda x: length(coalesce(x.t, '')) > 0)[1] AS f
           FROM looked WHERE kind = 'purchase'),
captions AS (SELECT doc, pos, CASE WHEN f IS NULL OR f.s THEN '' ELSE f.t END AS caption FROM firsts)"""


def captions(spark: SparkSession, sf: str, name) -> DataFrame:
    text = F.when(kind("view"), F.lit("")).otherwise(F.col("text"))
    return sq.caption_lookahead(ev(spark, sf), DOC, kind("purchase"), name, text, kind("error"))


@query("caption_lookahead", f"""
WITH {EV}, {CAPTIONS}
SELECT doc, CAST(pos % 3 AS INT) AS name, max_by(caption, pos) AS caption FROM captions GROUP BY ALL""")
def caption_lookahead(spark: SparkSession, sf: str) -> DataFrame:
    # Three names per document, so that later captions overwrite earlier ones.
    return captions(spark, sf, (F.col("pos") % 3).cast("int"))


@query("fence_state", rf"""
WITH {EV}, t AS (
  SELECT *, coalesce(sum(CAST(kind = 'signup' AS INT)) OVER b, 0) AS codes,
         coalesce(sum(CAST(kind = 'purchase' AS INT)) OVER b, 0) AS toggles
  FROM ev WINDOW b AS (PARTITION BY doc ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s AS (SELECT *, last_value(CASE kind WHEN 'click' THEN 1 - toggles WHEN 'error' THEN -toggles END IGNORE NULLS)
        OVER (PARTITION BY doc ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS base FROM t)
SELECT doc, pos, CAST(codes % 2 AS INT) AS in_code,
       CAST((((coalesce(base, 0) + toggles) % 2) + 2) % 2 AS INT) AS in_display FROM s""")
def fence_state(spark: SparkSession, sf: str) -> DataFrame:
    states = sq.fence_state(
        ev(spark, sf), DOC, kind("signup"), kind("purchase"), kind("click"), kind("error"))
    return states.select("doc", "pos", "in_code", "in_display")


@query("section_starts", f"""
WITH {EV}, {INHERIT}, n AS (
  SELECT *, CAST(sum(CAST(kind = 'signup' AS INT)) OVER (PARTITION BY doc ORDER BY pos) AS BIGINT) AS section FROM inh)
SELECT doc, section, min_by(eff_page, pos) AS start_page, count(*) AS n_blocks FROM n GROUP BY doc, section""")
def section_starts(spark: SparkSession, sf: str) -> DataFrame:
    return sq.section_starts(ev(spark, sf), DOC, kind("signup"))


@query("edit_nearest", f"""
WITH {EV}, e AS (SELECT doc, min(pos) FILTER (WHERE kind = 'purchase') AS e FROM ev GROUP BY doc),
s AS (SELECT ev.doc, e, max(pos) FILTER (WHERE kind = 'signup' AND pos < e) AS s
      FROM ev JOIN e ON e.doc = ev.doc GROUP BY ev.doc, e)
SELECT ev.doc, pos, CASE WHEN e - s <= 400 AND pos = s THEN '[replaced]' ELSE text END AS text
FROM ev JOIN s ON s.doc = ev.doc
WHERE NOT coalesce(e - s <= 400 AND pos > s AND pos < e, false)""")
def edit_nearest(spark: SparkSession, sf: str) -> DataFrame:
    edited = sq.edit_nearest(
        ev(spark, sf), DOC, kind("signup"), kind("purchase"), F.lit("[replaced]"), max_distance=400)
    return edited.select("doc", "pos", "text")


@query("edit_section", """
WITH s AS (SELECT conv_id, min(turn) FILTER (WHERE role = 'assistant') AS s FROM conversations GROUP BY 1),
e AS (SELECT c.conv_id, s, min(turn) FILTER (WHERE role = 'user' AND turn >= s) AS e
      FROM conversations c JOIN s ON s.conv_id = c.conv_id GROUP BY 1, 2)
SELECT c.conv_id, turn, role, CASE WHEN e > s AND turn = s THEN '[section]' ELSE text END AS text
FROM conversations c JOIN e ON e.conv_id = c.conv_id
WHERE NOT coalesce(e > s AND turn > s AND turn < e, false)""")
def edit_section(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    return sq.edit_section(
        turns, ["conv_id"], F.col("role") == "assistant", F.col("role") == "user",
        F.lit("[section]"), pos="turn")


@query("export_chunks", f"""
WITH {EV}, {TAIL},
left_ev AS (SELECT * FROM ev WHERE NOT EXISTS (
  SELECT 1 FROM tail WHERE tail.doc = ev.doc AND tail.s <= ev.pos AND ev.pos < tail.e)),
inh AS (SELECT *, coalesce(last_value(page IGNORE NULLS) OVER (PARTITION BY doc ORDER BY pos), 0) AS eff FROM left_ev),
g AS (SELECT *, eff - eff % 10 AS start_page,
             least(eff - eff % 10 + 9, coalesce(max(page) OVER (PARTITION BY doc), 0)) AS end_page FROM inh),
w0 AS (SELECT *, CASE WHEN page IS NOT NULL THEN
         CAST(page BETWEEN greatest(0, start_page - 2) AND end_page + 2 AS INT) END AS i FROM g),
w1 AS (SELECT *, max(i) OVER w AS seen, last_value(i IGNORE NULLS) OVER w AS lm FROM w0
       WINDOW w AS (PARTITION BY doc, start_page ORDER BY pos ROWS UNBOUNDED PRECEDING)),
w2 AS (SELECT * FROM w1 WHERE i = 1 OR (i IS NULL AND (coalesce(seen, 0) = 0 OR lm = 1))),
m0 AS (SELECT *, max(page) OVER (PARTITION BY doc, start_page ORDER BY pos
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx FROM w2),
m1 AS (SELECT *, last_value(CASE WHEN page IS NULL THEN NULL WHEN page < mx - 5 THEN 0 ELSE 1 END IGNORE NULLS)
         OVER (PARTITION BY doc, start_page ORDER BY pos) AS keep FROM m0),
c0 AS (SELECT * FROM m1 WHERE coalesce(keep, 1) = 1 AND NOT (start_page >= 50 AND kind = 'purchase')),
d0 AS (SELECT *, row_number() OVER (PARTITION BY doc, start_page, page, kind = 'view' ORDER BY pos) AS n FROM c0),
d1 AS (SELECT * FROM d0 WHERE kind <> 'view' OR n = 1),
t AS (SELECT doc, start_page, end_page, pos, 'block ' || replace(text, '#', ' no. ') AS text FROM d1)
SELECT doc, start_page, CAST(end_page AS INT) AS end_page, 0 AS part, CAST(count(*) AS INT) AS n_blocks,
       string_agg(text, chr(10) || chr(10) ORDER BY pos) AS text,
       format('{{:03d}}-{{:03d}}', start_page, end_page) AS page_range
FROM t GROUP BY doc, start_page, end_page""")
def export(spark: SparkSession, sf: str) -> DataFrame:
    blocks = sq.remove_ranges(ev(spark, sf), _tail(spark, sf), DOC)
    return export_chunks(
        with_pages(blocks), DOC, contaminated=kind("purchase"), contaminated_from=50,
        ref=F.when(kind("view"), F.col("page")), width=10, tolerance=2, jump=5,
        style=lambda t: F.concat(F.lit("block "), F.replace(t, F.lit("#"), F.lit(" no. "))))


CLEAN = (Rule("press", r"^click#", "press#"), Rule("zeros", r"0{2,}$", "0"))


@query("export_lifecycle", f"""
WITH {EV}, {TAIL},
left_ev AS (SELECT * REPLACE (regexp_replace(regexp_replace(text, '^click#', 'press#', 'g'), '0{{2,}}$', '0', 'g') AS text)
  FROM ev WHERE NOT EXISTS (SELECT 1 FROM tail WHERE tail.doc = ev.doc AND tail.s <= ev.pos AND ev.pos < tail.e)),
marked AS (SELECT *, last_value(CASE WHEN kind = 'signup' THEN 1 WHEN kind IN ('error', 'purchase') THEN 0 END IGNORE NULLS)
  OVER (PARTITION BY doc ORDER BY pos) AS skip FROM left_ev),
kept AS (SELECT * EXCLUDE (skip) FROM marked WHERE coalesce(skip, 0) = 0),
inh AS (SELECT *, coalesce(last_value(page IGNORE NULLS) OVER (PARTITION BY doc ORDER BY pos), 0) AS eff FROM kept),
g AS (SELECT *, eff - eff % 10 AS start_page,
             least(eff - eff % 10 + 9, coalesce(max(page) OVER (PARTITION BY doc), 0)) AS end_page FROM inh),
w0 AS (SELECT *, CASE WHEN page IS NOT NULL THEN
         CAST(page BETWEEN greatest(0, start_page - 2) AND end_page + 2 AS INT) END AS i FROM g),
w1 AS (SELECT *, max(i) OVER w AS seen, last_value(i IGNORE NULLS) OVER w AS lm FROM w0
       WINDOW w AS (PARTITION BY doc, start_page ORDER BY pos ROWS UNBOUNDED PRECEDING)),
w2 AS (SELECT * FROM w1 WHERE i = 1 OR (i IS NULL AND (coalesce(seen, 0) = 0 OR lm = 1))),
m0 AS (SELECT *, max(page) OVER (PARTITION BY doc, start_page ORDER BY pos
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx FROM w2),
m1 AS (SELECT *, last_value(CASE WHEN page IS NULL THEN NULL WHEN page < mx - 5 THEN 0 ELSE 1 END IGNORE NULLS)
         OVER (PARTITION BY doc, start_page ORDER BY pos) AS keep FROM m0),
c0 AS (SELECT * FROM m1 WHERE coalesce(keep, 1) = 1 AND NOT (start_page >= 50 AND kind = 'purchase')),
d0 AS (SELECT *, row_number() OVER (PARTITION BY doc, start_page, page, kind = 'view' ORDER BY pos) AS n FROM c0),
d1 AS (SELECT * FROM d0 WHERE kind <> 'view' OR n = 1),
t AS (SELECT doc, start_page, end_page, pos, 'block ' || replace(text, '#', ' no. ') AS text FROM d1),
r AS (SELECT *, starts_with(text, 'block error') AS sent FROM t)
SELECT doc, start_page, CAST(end_page AS INT) AS end_page, 0 AS part, 0 AS piece, CAST(count(*) AS INT) AS n_blocks,
       CAST(count(*) FILTER (WHERE sent) AS INT) AS n_sent, format('{{:03d}}-{{:03d}}', start_page, end_page) AS page_range,
       replace(string_agg(CASE WHEN sent THEN replace(text, 'error', 'fault') ELSE text END, chr(10) || chr(10) ORDER BY pos),
               'fault no.', 'fault number') AS text
FROM r GROUP BY doc, start_page, end_page""")
def lifecycle(spark: SparkSession, sf: str) -> DataFrame:
    """End matter, clean-up, dropped sections, export, second pass and final style in one plan."""
    heading = kind("error", "purchase", "signup")
    return export_lifecycle(
        with_pages(ev(spark, sf)), DOC, section=kind("error"), heading=heading, appendix=kind("purchase"),
        end_matter=kind("signup"), margin=5, rules=CLEAN, dropped=kind("signup"), contaminated=kind("purchase"),
        contaminated_from=50, ref=F.when(kind("view"), F.col("page")), width=10, tolerance=2, jump=5,
        style=lambda t: F.concat(F.lit("block "), F.replace(t, F.lit("#"), F.lit(" no. "))),
        residual=lambda t: t.startswith("block error"), service=lambda t: F.replace(t, F.lit("error"), F.lit("fault")),
        restyle=lambda t: F.replace(t, F.lit("fault no."), F.lit("fault number")))
