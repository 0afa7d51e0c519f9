"""The operators applied to whole tables, under the names the driver calls."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm import (
    bpe_codec, brown_lm, decontaminate, html_extract, language_id, lexical_search, pii_spans, quality, simhash_dedup,
    suffix_dedup, token_counts, url_filter, whitening)
from corpusprep.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]

RULES = (
    url_filter.Rule("allow", "org/"), url_filter.Rule("block", "example.org/es/"),
    url_filter.Rule("block", "example.org/en/1"), url_filter.Rule("allow", "com/fr/"),
    url_filter.Rule("block", "com/de/"),
)
TOKEN_LIMIT = 1024


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op2_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    done = suffix_dedup.remove_repeats(table(spark, sf, "documents"), "doc_id")
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_bpe_codec(spark: SparkSession, sf: str) -> DataFrame:
    done = bpe_codec.round_trip(table(spark, sf, "documents"), tokenizer())
    return done.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_brown_lm(spark: SparkSession, sf: str) -> DataFrame:
    return brown_lm.score_documents(table(spark, sf, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_simhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(table(spark, sf, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language_id.identify(table(spark, sf, "documents"))


def op7_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf, "pages"), RULES)


def op8_html_extract(spark: SparkSession, sf: str) -> DataFrame:
    return html_extract.extract(table(spark, sf, "pages"), "page_id", "url")


def op9_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = token_counts.token_counts(
        table(spark, sf, "documents"), tokenizer(), shared_dir(spark, "token-counts"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op11_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(table(spark, sf, "embeddings"))


def op12_pii_spans(spark: SparkSession, sf: str) -> DataFrame:
    return pii_spans.digests(pii_spans.find(table(spark, sf, "documents")))


def op13_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return lexical_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


QUERIES: dict[str, Query] = {
    q.__name__: q for q in (
        op1_quality_rules, op2_suffix_dedup, op3_bpe_codec, op4_brown_lm, op5_simhash_dedup, op6_language_id,
        op7_url_filter, op8_html_extract, op9_token_counts, op10_decontaminate,
        op11_embedding_whitening, op12_pii_spans, op13_lexical_search)
}

TERM = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op13_lexical_search": f"""
        WITH held AS (SELECT doc_id, regexp_extract_all({LOWER}, '{TERM}') AS t FROM documents),
        docs AS (SELECT row_number() OVER () AS d, doc_id, t, len(t) AS n FROM held WHERE len(t) > 0),
        whole AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM docs),
        tf AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(t) AS term FROM docs) GROUP BY d, term),
        asked AS (SELECT item_id, term, count(*) AS repeats
                  FROM (SELECT item_id, unnest(regexp_extract_all({LOWER}, '{TERM}')) AS term
                        FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item_id, term),
        weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
                    FROM tf, whole WHERE term IN (SELECT term FROM asked) GROUP BY term),
        scores AS (SELECT item_id, d, CAST(sum(repeats * w * ((1000000000 * tf) // (
                       1000 * tf + 12 * (100 - 25 + ((25 * n * big_n) // big_l))))) AS BIGINT) AS score
                   FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN docs USING (d), whole GROUP BY item_id, d),
        ranked AS (SELECT item_id, doc_id, score,
                          row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
                   FROM scores JOIN docs USING (d) WHERE score > 0)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20""",
}
