"""The documents pipeline: each stage reads what the one before it wrote.

Language ID, SimHash near-duplicates, suffix-array repeats, benchmark decontamination, BPE.

Cases: a NULL text, or one without a letter, goes in the first stage; repeated rows and rows
without an id are documents like any other, and of a group of near-duplicates one row stays; a
text that the repeats stage empties stays as an empty one; an empty table gives an empty result;
further columns, whatever their names, come through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm import bpe_codec, decontaminate, language_id, simhash_dedup, suffix_dedup
from corpusprep.llm.common import remainder
from corpusprep.llm.queries import table, tokenizer
from corpusprep.session import materialise, ship


def _plain(docs: DataFrame) -> tuple[DataFrame, list[str], str]:
    """The table under names no operator uses, those names, and the text's."""
    names = [f"__c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), names, names[docs.columns.index("text")]


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language, which replaces the one they came with.

    The model learns from the input's own labels, as in its query.
    """
    ship(spark)
    rest = remainder(F.col("doc_id"), 4)
    model = language_id.fit(docs.filter(rest != 2))
    plain, names, text = _plain(docs)
    found = language_id.predict(plain, model, *names, text=text).filter(F.col("lang_pred") != language_id.NONE)
    lang = names[docs.columns.index("lang")]
    return found.withColumn(lang, F.col("lang_pred")).select(*names).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    ship(spark)
    return simhash_dedup.keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 200 bytes that occur at two places.

    A character that a cut goes through goes as a whole. ``n_chars`` follows the text.
    """
    ship(spark)
    plain, names, text = _plain(docs)
    others = [n for n in names if n != text]
    done = suffix_dedup.remove_repeats(plain, *others, text=text, characters=True)
    done = done.withColumn(text, F.col("kept").cast("string")).withColumn(
        names[docs.columns.index("n_chars")], F.length(text).cast("bigint"))
    return done.select(*names).toDF(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, and what they decode to, as digests."""
    ship(spark)
    done = bpe_codec.round_trip(docs, tokenizer())
    return done.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", languages),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("benchmark", benchmark),
    ("bpe", encoded),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ship(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
