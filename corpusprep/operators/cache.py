"""Translation cache keyed by the MD5 of a chunk's UTF-8 text."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.operators.lookup import lookup
from corpusprep.session import materialise

# Tokens that mark a cached translation as poisoned.
POISON = ("HIDE", "MATHBLK", "MATHINL")


def poisoned(translated: Column | str, source: Column | str | None = None,
             tokens: Sequence[str] = POISON) -> Column:
    """Does a cached value carry placeholder tokens.

    With ``source``, tokens that the source itself has are no sign of poison: masked
    chunks carry them rightly and would otherwise never be served from the cache.
    """
    bad = F.lit(False)
    for t in tokens:
        hit = tx.col(translated).contains(t)
        if source is not None:
            hit = hit & ~F.coalesce(tx.col(source).contains(t), F.lit(False))
        bad = bad | hit
    return F.coalesce(bad, F.lit(False))


def cache_lookup(
    chunks: DataFrame, cache: DataFrame, row_id: Sequence[str], text: str = "text",
    mode: str = "foreign", **skew: int,
) -> DataFrame:
    """Add ``md5``, ``translated`` and ``status``: ``hit``, ``miss`` or ``poisoned``."""
    keyed = chunks.withColumn("md5", tx.digest(text))
    entries = cache.select("md5", "translated", F.lit(1).alias("__known"))
    found = lookup(keyed, entries, ["md5"], row_id, **skew)
    bad = poisoned("translated", text if mode == "foreign" else None)
    status = F.when(F.col("__known").isNull(), "miss").when(bad, "poisoned").otherwise("hit")
    return found.select(
        *chunks.columns, "md5", F.when(status == "hit", F.col("translated")).alias("translated"),
        status.alias("status"),
    )


def cache_misses(chunks: DataFrame, cache: DataFrame, row_id: Sequence[str],
                 text: str = "text", **skew: int) -> DataFrame:
    """Chunks whose text has no cache entry."""
    keyed = chunks.withColumn("md5", tx.digest(text))
    return lookup(keyed, cache.select("md5"), ["md5"], row_id, "left_anti", **skew)


def evict_poisoned(cache: DataFrame, tokens: Sequence[str] = POISON) -> DataFrame:
    return cache.filter(~poisoned("translated", tokens=tokens))


def cache_upsert(cache: DataFrame, new: DataFrame) -> DataFrame:
    """Union in which the new value of a key wins; a partial aggregate, no window."""
    both = cache.select("md5", "translated", F.lit(0).alias("__age")).unionByName(
        new.select("md5", "translated", F.lit(1).alias("__age"))
    )
    best = F.max(F.struct("__age", "translated"))
    return both.groupBy("md5").agg(best.alias("__b")).select("md5", F.col("__b.translated").alias("translated"))


def by_pandas(fn: Callable[[pd.Series], pd.Series]) -> Callable[[DataFrame], DataFrame]:
    """Make a service of a function on batches of texts."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"md5": frame["md5"], "translated": fn(frame["text"])})

    return lambda df: df.select("md5", "text").mapInPandas(batches, "md5 string, translated string")


def translate(
    chunks: DataFrame, cache: DataFrame, service: Callable[[DataFrame], DataFrame],
    row_id: Sequence[str], text: str = "text", mode: str = "foreign", **skew: int,
) -> tuple[DataFrame, DataFrame]:
    """Serve hits from the cache and the rest through ``service``.

    ``service`` maps ``(md5, text)`` to ``(md5, translated)``. Texts are made
    distinct first, by a partial aggregate, so copies cost nothing: the cache is
    probed and the service asked once per text, key against key. Only handing
    the answers back to the chunks meets hot keys. Returns the chunks with
    ``md5``, ``translated`` and ``from_cache``, and the fresh cache entries, which
    are written first: both results read them and the service is asked once.
    NULL texts are not sent and come back as NULL.
    """
    keyed = chunks.withColumn("md5", tx.digest(text))
    distinct = keyed.filter(F.col("md5").isNotNull()).groupBy("md5").agg(F.max(text).alias("text"))
    looked = distinct.join(cache.select("md5", "translated"), "md5", "left")
    bad = poisoned("translated", "text" if mode == "foreign" else None)
    usable = F.col("translated").isNotNull() & ~bad
    hits = looked.filter(usable).select("md5", "translated", F.lit(1).alias("from_cache"))
    fresh = materialise(
        service(looked.filter(~usable).select("md5", "text")).select("md5", "translated"), "answers")
    answers = hits.unionByName(fresh.withColumn("from_cache", F.lit(0)))
    done = lookup(keyed, answers, ["md5"], row_id, **skew)
    return done.select(*chunks.columns, "md5", "translated", "from_cache"), fresh
