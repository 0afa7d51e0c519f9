"""Lookups, replacements, links, caches and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.catalog.base import (
    EV, GLOSSARY, LN, PHRASES, SP, documents, ln, query, sql_glossary, sql_mask, table)
from corpusprep.catalog.events import CAPTIONS, captions
from corpusprep.functions import text as tx
from corpusprep.operators import assets as at
from corpusprep.operators import audit as au
from corpusprep.operators import cache as ca
from corpusprep.operators.align import align_revisions
from corpusprep.operators.cache_store import CacheStore, lookup_stored
from corpusprep.operators.glossary import rewrite_by_table
from corpusprep.operators.intervals import in_ranges
from corpusprep.operators.rules import Rule, glossary_rewrite, rewrite
from corpusprep.operators.spans import mask_spans
from corpusprep.session import materialise, shared_dir

ASSET_KINDS = (("figure", r"page="), ("picture", r"#top$"))
PAGE = r"[?&]page=(\d+)"

ASSET_SQL = r"""CASE WHEN regexp_matches(lower(file_name), 'page=') THEN 'figure'
     WHEN regexp_matches(lower(file_name), '#top$') THEN 'picture' ELSE 'image' END"""
PAGE_SQL = r"TRY_CAST(nullif(regexp_extract(file_name, '[?&]page=(\d+)', 1), '') AS INT)"
NAMES = "names AS (SELECT page_id, url, list_last(string_split(url, '/')) AS file_name, html FROM pages)"


@query("asset_attrs", f"""
WITH {NAMES} SELECT page_id, {ASSET_SQL} AS asset_type, {PAGE_SQL} AS page_number FROM names""")
def asset_attrs(spark: SparkSession, sf: str) -> DataFrame:
    named = table(spark, sf, "pages").withColumn("file_name", tx.basename("url"))
    return named.select(
        "page_id", at.asset_type("file_name", ASSET_KINDS, "image").alias("asset_type"),
        at.page_number("file_name", PAGE).alias("page_number"))


BASE_PROMPT = "Redraw this illustration cleanly and keep every label."
KIND_PROMPTS = {"figure": " Use plain vector lines.", "picture": " Keep all notes.", "image": " Stay neutral."}


@query("asset_manifest", f"""
WITH {NAMES},
heads AS (SELECT file_name, max_by(regexp_extract(html, '<h1>([^<]*)</h1>', 1), page_id) AS caption
          FROM names WHERE contains(url, '?') GROUP BY file_name),
typed AS (SELECT DISTINCT n.file_name, n.url, {ASSET_SQL.replace('file_name', 'n.file_name')} AS asset_type,
            {PAGE_SQL.replace('file_name', 'n.file_name')} AS page_number, coalesce(h.caption, '') AS caption
          FROM names n LEFT JOIN heads h ON h.file_name = n.file_name)
SELECT file_name, url AS source_path, 'work/input_images/' || file_name AS input_path,
       'work/processed_images/' || file_name AS processed_path,
       'work/prompts/' || regexp_replace(file_name, '\\.[^.]*$', '') || '.txt' AS prompt_path,
       page_number, asset_type, caption,
       '{BASE_PROMPT}' || CASE asset_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in KIND_PROMPTS.items())} END
         || CASE WHEN caption <> '' THEN ' Caption/context: ' || caption ELSE '' END AS prompt
FROM typed""")
def asset_manifest(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    heads = (
        pages.filter(F.col("url").contains("?"))
        .groupBy(tx.basename("url").alias("file_name"))
        .agg(F.max_by(F.regexp_extract("html", "<h1>([^<]*)</h1>", 1), "page_id").alias("caption"))
    )
    files = pages.select(F.col("url").alias("path")).distinct()
    return at.asset_table(files, heads, ASSET_KINDS, "image", BASE_PROMPT, KIND_PROMPTS, "work/",
                          page_pattern=PAGE)


@query("attach_captions", f"""
WITH {EV}, {CAPTIONS}, last AS (SELECT doc, max_by(caption, pos) AS caption FROM captions GROUP BY doc)
SELECT page_id, url, coalesce(caption, '') AS caption FROM pages LEFT JOIN last ON doc = page_id""")
def attach_captions(spark: SparkSession, sf: str) -> DataFrame:
    per_user = captions(spark, sf, F.lit("all")).select(F.col("doc").alias("page_id"), "caption")
    pages = table(spark, sf, "pages").select("page_id", "url")
    return at.attach_captions(pages, per_user, ["page_id"], ["page_id"])


@query("apply_replacements", """
SELECT c_custkey, 'updated' AS outcome, coalesce(p_name, c_name) AS c_name
FROM customer LEFT JOIN part ON p_partkey = c_custkey
UNION ALL SELECT c_custkey, 'backup', c_name FROM customer JOIN part ON p_partkey = c_custkey
UNION ALL SELECT p_partkey, 'skipped', p_name FROM part
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = p_partkey)""")
def apply_replacements(spark: SparkSession, sf: str) -> DataFrame:
    target = table(spark, sf, "customer").select("c_custkey", "c_name")
    processed = table(spark, sf, "part").select(
        F.col("p_partkey").alias("c_custkey"), F.col("p_name").alias("c_name"))
    out = at.apply_replacements(target, processed, "c_custkey", "c_name")
    tagged = [df.select("c_custkey", F.lit(name).alias("outcome"), "c_name") for name, df in out.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@query("resolve_links", """
WITH l AS (SELECT page_id, CAST(i - 1 AS INT) AS link_no, substr(hs[i], 2) AS target
  FROM (SELECT page_id, hs, unnest(range(1, len(hs) + 1)) AS i
        FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hs FROM pages))),
inv AS (SELECT target AS path FROM l GROUP BY target HAVING count(DISTINCT page_id) >= 5)
SELECT page_id, link_no, target, CASE WHEN a.path IS NOT NULL THEN 'exact' WHEN b.path IS NOT NULL THEN 'name'
         ELSE 'unresolved' END AS via,
       CASE WHEN a.path IS NOT NULL THEN 'images/' || a.path WHEN b.path IS NOT NULL THEN 'images/' || b.path
         ELSE target END AS resolved
FROM l LEFT JOIN inv a ON a.path = target LEFT JOIN inv b ON b.path = lower(target)""")
def resolve_links(spark: SparkSession, sf: str) -> DataFrame:
    hrefs = tx.find_all("html", 'href="([^"]*)"', 1)
    links = table(spark, sf, "pages").select("page_id", F.posexplode(hrefs).alias("link_no", "href")).select(
        "page_id", "link_no", F.substring("href", 2, 2147483647).alias("target"))
    # A target's pages are counted after a partial distinct, so a popular target stays cheap.
    inventory = (
        links.select("target", "page_id").distinct().groupBy(F.col("target").alias("path"))
        .agg(F.count("*").alias("n")).filter("n >= 5").select("path"))
    return at.resolve_links(links, inventory, ["page_id", "link_no"], key=F.lower("__t"))


RANGES = "1-2,2-4,7"


@query("select_ranges", """
SELECT conv_id, turn, range_no FROM conversations
JOIN (VALUES (1, 1, 2), (2, 2, 4), (3, 7, 7)) AS r(range_no, a, b) ON turn + 1 BETWEEN a AND b""")
def select_ranges(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").withColumn("number", F.col("turn") + 1)
    return au.select_ranges(turns, au.parse_ranges(RANGES), "number").select("conv_id", "turn", "range_no")


@query("range_violations", """
SELECT conv_id, n AS n_numbers, range_no, CAST(b AS BIGINT) AS range_end
FROM (SELECT conv_id, max(turn) + 1 AS n FROM conversations GROUP BY conv_id)
JOIN (VALUES (1, 2), (2, 4), (3, 7)) AS r(range_no, b) ON b > n""")
def range_violations(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").withColumn("number", F.col("turn") + 1)
    return au.range_violations(turns, ["conv_id"], au.parse_ranges(RANGES), "number")


DAY = "date_diff('day', DATE '1992-01-01', CAST({} AS DATE))"


@query("ranges_by_table", f"""
WITH r AS (SELECT l_suppkey AS doc, l_orderkey * 10 + l_linenumber AS range_no, {DAY.format("l_shipdate")} AS a,
                  {DAY.format("l_shipdate")} + CAST(l_quantity AS BIGINT) AS b FROM lineitem WHERE l_returnflag = 'R'),
p AS (SELECT o_orderkey, o_custkey % 100 + 1 AS doc, {DAY.format("o_orderdate")} AS d FROM orders)
SELECT o_orderkey, range_no FROM p JOIN r ON p.doc = r.doc AND d BETWEEN a AND b""")
def ranges_by_table(spark: SparkSession, sf: str) -> DataFrame:
    """Orders within the delivery ranges of the supplier that has their customer's number."""
    day = lambda c: F.date_diff(F.col(c).cast("date"), F.lit("1992-01-01").cast("date")).cast("bigint")
    ranges = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_suppkey").alias("doc"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("range_no"),
        day("l_shipdate").alias("first"), (day("l_shipdate") + F.col("l_quantity").cast("bigint")).alias("last"))
    orders = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_custkey") % 100 + 1).alias("doc"), day("o_orderdate").alias("number"))
    return in_ranges(orders, ranges, "number", ["doc"], ["o_orderkey"]).select("o_orderkey", "range_no")


@query("donor_fill", """
SELECT doc_id, coalesce(quality, d) AS quality,
       CASE WHEN quality IS NULL THEN 'insert' WHEN d IS NULL OR quality = d THEN 'present' ELSE 'verify' END AS status
FROM labels FULL JOIN (SELECT doc_id, CAST(n_chars >= 200 AS INT) AS d FROM documents) USING (doc_id)""")
def donor_fill(spark: SparkSession, sf: str) -> DataFrame:
    donor = table(spark, sf, "documents").select(
        "doc_id", (F.col("n_chars") >= 200).cast("int").alias("quality"))
    return au.donor_fill(table(spark, sf, "labels"), donor, ["doc_id"], "quality")


REVISION = (
    Rule("symbols", r"\$\$\$|%%%|###", ""),
    Rule("licence_line", r"(?m)^(?:This work is licensed|Licensed|Released) under [^\n]*\n?", ""),
)


@query("revision_diff", rf"""
WITH {LN}, rev AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(text, '{REVISION[0].pattern}', '', 'g'),
    '{REVISION[1].pattern}', '', 'g'), chr(10)) AS ls FROM documents),
b AS (SELECT doc_id, CAST(i - 1 AS INT) AS line_no, ls[i] AS line FROM (
        SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM rev)),
d AS (SELECT doc_id, line_no, CASE WHEN ln.line IS NULL THEN 'added' WHEN b.line IS NULL THEN 'removed'
        WHEN ln.line = b.line THEN 'same' ELSE 'changed' END AS change
      FROM ln FULL JOIN b USING (doc_id, line_no))
SELECT doc_id, count(*) FILTER (WHERE change = 'added') AS n_added,
       count(*) FILTER (WHERE change = 'removed') AS n_removed,
       count(*) FILTER (WHERE change = 'changed') AS n_changed,
       count(*) FILTER (WHERE change = 'same') AS n_same FROM d GROUP BY doc_id""")
def revision_diff(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    new = rewrite(docs, REVISION).select("doc_id", F.posexplode(tx.lines("text")).alias("line_no", "line"))
    changes = au.revision_diff(ln(spark, sf), new, ["doc_id", "line_no"], "line")
    return changes.groupBy("doc_id").agg(*[
        F.count_if(F.col("change") == c).alias(f"n_{c}") for c in ("added", "removed", "changed", "same")])


DROPPED = "^(?:This work is licensed|Licensed|Released) under "


@query("revision_align", rf"""
WITH {LN}, a AS (SELECT doc_id, CAST(line_no AS BIGINT) AS p, line_no || ':' || line AS t FROM ln),
b AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS p,
             line_no || ':' || regexp_replace(line, '{REVISION[0].pattern}', '', 'g') AS t
      FROM ln WHERE NOT regexp_matches(line, '{DROPPED}')
      UNION ALL SELECT doc_id, 0, 'revised' FROM documents WHERE text IS NOT NULL),
fa AS (SELECT a.doc_id, a.p, a.t, (b.t IS NOT NULL)::INT AS hit FROM a LEFT JOIN b ON a.doc_id = b.doc_id AND a.t = b.t),
fb AS (SELECT b.doc_id, b.p, b.t, (a.t IS NOT NULL)::INT AS hit FROM b LEFT JOIN a ON a.doc_id = b.doc_id AND a.t = b.t),
ga AS (SELECT doc_id, gap, count(*) FILTER (WHERE hit = 0) AS n, sum(hit) AS hits FROM (
  SELECT *, sum(hit) OVER (PARTITION BY doc_id ORDER BY p) AS gap FROM fa) GROUP BY ALL),
gb AS (SELECT doc_id, gap, count(*) FILTER (WHERE hit = 0) AS n FROM (
  SELECT *, sum(hit) OVER (PARTITION BY doc_id ORDER BY p) AS gap FROM fb) GROUP BY ALL),
g AS (SELECT doc_id, coalesce(ga.n, 0) AS na, coalesce(gb.n, 0) AS nb, coalesce(hits, 0) AS hits FROM ga FULL JOIN gb USING (doc_id, gap))
SELECT doc_id, CAST(sum(greatest(nb - na, 0)) AS BIGINT) AS n_added, CAST(sum(greatest(na - nb, 0)) AS BIGINT) AS n_removed,
       CAST(sum(least(na, nb)) AS BIGINT) AS n_changed, CAST(sum(hits) AS BIGINT) AS n_same FROM g GROUP BY doc_id""")
def revision_align(spark: SparkSession, sf: str) -> DataFrame:
    """A revision with a new first line, licence lines left out and other lines mended."""
    docs = documents(spark, sf).filter("text IS NOT NULL")
    old = ln(spark, sf).select("doc_id", "line_no", F.concat_ws(":", "line_no", "line").alias("block"), "line")
    mended = F.concat_ws(":", "line_no", F.regexp_replace("line", REVISION[0].pattern, ""))
    new = old.filter(~F.col("line").rlike(DROPPED)).select("doc_id", "line_no", mended.alias("block")).unionByName(
        docs.select("doc_id", F.lit(-1).alias("line_no"), F.lit("revised").alias("block")))
    changes = align_revisions(old, new, ["doc_id"], "line_no", "block")
    return changes.groupBy("doc_id").agg(*[
        F.count_if(F.col("change") == c).alias(f"n_{c}") for c in ("added", "removed", "changed", "same")])


# -- cache ---------------------------------------------------------------------

def seed_cache(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents have been translated before; toxic ones left a poisoned entry."""
    labelled = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    value = F.when(F.col("toxic") == 1, "MATHBLK0000X").otherwise(F.concat(F.lit("done:"), F.upper("lang")))
    entries = labelled.select(tx.digest("text").alias("md5"), value.alias("translated"))
    # A cache is a stored table, whose size the lookups can check.
    return materialise(entries.groupBy("md5").agg(F.max("translated").alias("translated")), "cache")


CACHE = """cache AS (
  SELECT md5(text) AS md5, max(CASE WHEN toxic = 1 THEN 'MATHBLK0000X' ELSE 'done:' || upper(lang) END) AS translated
  FROM documents JOIN labels USING (doc_id) GROUP BY 1)"""


@query("cache_misses", f"""
WITH {CACHE}
SELECT doc_id, md5(text) AS md5 FROM documents WHERE md5(text) NOT IN (SELECT md5 FROM cache)""")
def cache_misses(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return ca.cache_misses(docs, seed_cache(spark, sf), ["doc_id"]).select("doc_id", "md5")


@query("cache_status", f"""
WITH {CACHE}, l AS (SELECT doc_id, d.text, c.translated FROM documents d LEFT JOIN cache c ON c.md5 = md5(d.text))
SELECT doc_id, CASE WHEN translated IS NULL THEN 'miss' WHEN contains(translated, 'MATHBLK') THEN 'poisoned' ELSE 'hit' END AS status,
       CASE WHEN NOT contains(translated, 'MATHBLK') THEN translated END AS translated FROM l""")
def cache_status(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return ca.cache_lookup(docs, seed_cache(spark, sf), ["doc_id"]).select("doc_id", "status", "translated")


@query("cache_upsert", f"""
WITH {CACHE}, new AS (SELECT md5(text) AS md5, max('new:' || source) AS translated FROM documents WHERE lang = 'fr' GROUP BY 1)
SELECT md5, translated FROM new UNION ALL
SELECT md5, translated FROM cache WHERE md5 NOT IN (SELECT md5 FROM new)""")
def cache_upsert(spark: SparkSession, sf: str) -> DataFrame:
    french = table(spark, sf, "documents").filter("lang = 'fr'")
    new = french.select(
        tx.digest("text").alias("md5"), F.concat(F.lit("new:"), "source").alias("translated"))
    return ca.cache_upsert(seed_cache(spark, sf), new)


NEW_ENTRIES = """new AS (SELECT md5(text) AS md5, max('new:' || source) AS translated FROM documents WHERE lang = 'fr' GROUP BY 1),
united AS (SELECT md5, translated FROM new UNION ALL SELECT md5, translated FROM cache WHERE md5 NOT IN (SELECT md5 FROM new))"""


def stored_cache(spark: SparkSession, sf: str) -> CacheStore:
    """A store that has taken the seed, and then new entries for French texts."""
    store = CacheStore(spark, shared_dir(spark, "cache-store"))
    store.upsert(seed_cache(spark, sf))
    french = table(spark, sf, "documents").filter("lang = 'fr'")
    store.upsert(french.select(tx.digest("text").alias("md5"), F.concat(F.lit("new:"), "source").alias("translated")))
    return store


@query("cache_store_entries", f"WITH {CACHE}, {NEW_ENTRIES} SELECT md5, translated FROM united")
def cache_store_entries(spark: SparkSession, sf: str) -> DataFrame:
    return stored_cache(spark, sf).entries()


@query("cache_store_lookup", f"""
WITH {CACHE}, {NEW_ENTRIES}, l AS (SELECT doc_id, c.translated FROM documents d LEFT JOIN united c ON c.md5 = md5(d.text))
SELECT doc_id, CASE WHEN translated IS NULL THEN 'miss' WHEN contains(translated, 'MATHBLK') THEN 'poisoned' ELSE 'hit' END AS status,
       CASE WHEN NOT contains(translated, 'MATHBLK') THEN translated END AS translated FROM l""")
def cache_store_lookup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return lookup_stored(docs, stored_cache(spark, sf)).select("doc_id", "status", "translated")


@query("cache_poison", f"""
WITH {sql_mask('m', 'documents', ['doc_id', 'text'])},
c AS (SELECT md5(text) AS md5, max(masked) AS translated FROM m GROUP BY 1)
SELECT md5, CAST(length(translated) AS INT) AS n_chars FROM c
WHERE NOT regexp_matches(translated, '{'|'.join(k.prefix for k in SP)}')""")
def cache_poison(spark: SparkSession, sf: str) -> DataFrame:
    masked = mask_spans(documents(spark, sf), SP)
    cache = masked.select(tx.digest("text").alias("md5"), F.col("masked").alias("translated")).groupBy("md5").agg(
        F.max("translated").alias("translated"))
    clean = ca.evict_poisoned(cache, [k.prefix for k in SP])
    return clean.select("md5", F.length("translated").alias("n_chars"))


@query("translate_cached", f"""
WITH {CACHE}
SELECT doc_id, CAST(c.md5 IS NOT NULL AS INT) AS from_cache,
       md5(coalesce(c.translated, {sql_glossary('text', GLOSSARY)})) AS result
FROM documents d LEFT JOIN cache c ON c.md5 = md5(d.text) AND NOT contains(c.translated, 'MATHBLK')""")
def translate_cached(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text")

    def service(wanted: DataFrame) -> DataFrame:
        return glossary_rewrite(wanted, GLOSSARY, out="translated").select("md5", "translated")

    done, _ = ca.translate(docs, seed_cache(spark, sf), service, ["doc_id"])
    return done.select("doc_id", "from_cache", tx.digest("translated").alias("result"))


PHRASE_SQL = "masked"
for _p, _r in sorted(PHRASES.items(), key=lambda kv: -len(kv[0])):
    for _f, _t in ((_p.upper(), _r.upper()), (_p.title(), _r.capitalize()), (f"(?i){_p}", _r)):
        _flag, _body = ("(?i)", _f[4:]) if _f.startswith("(?i)") else ("", _f)
        # Neighbouring hits share a separator, so the pattern runs twice.
        for _ in range(2):
            PHRASE_SQL = (
                f"regexp_replace({PHRASE_SQL}, '{_flag}(^|[^\\p{{L}}\\p{{N}}_]){_body}($|[^\\p{{L}}\\p{{N}}_])', "
                f"'\\1{_t}\\2', 'g')")


@query("glossary_rewrite", f"""
WITH {sql_mask('m', 'documents', ['doc_id', 'text'])}, p AS (SELECT doc_id, {PHRASE_SQL} AS t FROM m)
SELECT doc_id, {sql_glossary('t', GLOSSARY)} AS rewritten FROM p""")
def glossary(spark: SparkSession, sf: str) -> DataFrame:
    masked = mask_spans(documents(spark, sf), SP)
    return glossary_rewrite(masked, GLOSSARY, PHRASES, "masked", "rewritten").select("doc_id", "rewritten")


WORD, NO_WORD = r"[A-Za-z]+", r"[^\p{L}\p{M}\p{N}_]"
FIRST = rf"(?:^|{NO_WORD})([A-Ma-m][A-Za-z]*)$"
SECOND = rf"^([N-Zn-z][A-Za-z]*)(?:$|{NO_WORD})"


def pair_glossary(docs: DataFrame) -> DataFrame:
    """Every pair of neighbouring words that begin with a-m and n-z, as a phrase."""
    # A text is split once: within a function over its words it would be split anew for each of them.
    split = tx.evaluated(docs, [], {"words": F.split("text", " ", -1)})
    after = F.slice("words", F.lit(2), F.greatest(F.size("words") - 1, F.lit(0)))
    words = split.select(F.inline(F.arrays_zip(F.col("words").alias("a"), after.alias("b"))))
    first = words.select(F.lower(F.regexp_extract("a", FIRST, 1)).alias("a"), "b").filter("a <> ''")
    pairs = first.select("a", F.lower(F.regexp_extract(F.coalesce("b", F.lit("")), SECOND, 1)).alias("b")).filter("b <> ''")
    return pairs.distinct().select(
        F.concat_ws(" ", "a", "b").alias("source"), F.concat_ws("_", "b", "a").alias("put"))


@query("glossary_by_table", f"""
WITH t AS (SELECT doc_id, string_split(text, ' ') AS ts FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, i, ts[i] AS t, regexp_extract(ts[i], '{FIRST}', 1) AS a,
             regexp_extract(coalesce(ts[i + 1], ''), '{SECOND}', 1) AS b
      FROM (SELECT doc_id, ts, unnest(range(1, len(ts) + 1)) AS i FROM t)),
p AS (SELECT *, a <> '' AND b <> '' AS hit, a || ' ' || b AS f, lower(b) || '_' || lower(a) AS r FROM w),
c AS (SELECT *, CASE WHEN f = upper(f) THEN upper(r)
        WHEN f = upper(a[1]) || lower(a[2:]) || ' ' || upper(b[1]) || lower(b[2:]) THEN upper(r[1]) || r[2:] ELSE r END AS put,
        lag(hit, 1, false) OVER o AS joined, lag(b, 1, '') OVER o AS before FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
d AS (SELECT *, CASE WHEN joined THEN t[len(before) + 1:] ELSE t END AS own FROM c)
SELECT doc_id, count(*) FILTER (WHERE hit) AS n_pairs,
       string_agg(CASE WHEN hit THEN own[:len(own) - len(a)] || put ELSE own || ' ' END, '' ORDER BY i) AS rewritten
FROM d GROUP BY doc_id""")
def glossary_by_table(spark: SparkSession, sf: str) -> DataFrame:
    """A glossary of all such pairs of the corpus itself, tens of thousands of phrases, in one pass."""
    docs = documents(spark, sf).select("doc_id", "text").filter("text IS NOT NULL")
    done = rewrite_by_table(docs, pair_glossary(docs))
    n = F.size(F.filter(F.split("rewritten", "_", -1), lambda x: x.isNotNull())) - F.size(F.split("text", "_", -1))
    return done.select("doc_id", n.cast("bigint").alias("n_pairs"), F.concat("rewritten", F.lit(" ")).alias("rewritten"))
