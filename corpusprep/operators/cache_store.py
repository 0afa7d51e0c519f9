"""The translation cache as a stored table that is probed where it lies.

Entries are kept in ``buckets`` files by a hash of their MD5, so a join on it moves the probing keys only.
New entries are written beside them as small deltas, dealt in the same way; nothing that is stored is
read or rewritten by an upsert. Every ``fan`` deltas are merged into the base, bucket by bucket and
without moving rows. A newer value of a key wins.

Folders are named by a running number: ``base-7`` holds all entries up to delta 7, deltas after it
are ``delta-8`` and so on. A folder counts once its write is complete, so a writer that fails leaves
nothing behind that is read, and the next one takes the same number. There is one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.operators.cache import POISON, poisoned
from corpusprep.operators.lookup import bounded

BUCKETS = 64
FAN = 8
SCHEMA = "md5 string, translated string"


class CacheStore:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, fan: int = FAN):
        self.spark, self.path, self.buckets, self.fan = spark, path.rstrip("/"), buckets, fan

    def _folders(self) -> tuple[int, list[int]]:
        """Number of the last complete base (-1: none), and the complete deltas after it."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        bases, deltas = [], []
        if fs.exists(path(self.path)):
            for entry in fs.listStatus(path(self.path)):
                kind, _, number = entry.getPath().getName().partition("-")
                if number.isdigit() and fs.exists(path(entry.getPath(), "_SUCCESS")):
                    (bases if kind == "base" else deltas).append(int(number))
        base = max(bases, default=-1)
        return base, sorted(d for d in deltas if d > base)

    def _table(self, folder: str) -> DataFrame:
        """A stored folder, with what Spark needs to know of its buckets. The name is gone at once."""
        name = f"cache_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} ({SCHEMA}) USING parquet CLUSTERED BY (md5) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}/{folder}'")
        try:
            return self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def _write(self, rows: DataFrame, folder: str) -> None:
        name = f"cache_{uuid.uuid4().hex}"
        rows.select("md5", "translated").write.format("parquet").mode("overwrite").option(
            "path", f"{self.path}/{folder}").bucketBy(self.buckets, "md5").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")

    def _parts(self) -> list[DataFrame]:
        """The stored tables, the newest first."""
        base, deltas = self._folders()
        return [self._table(f"delta-{d}") for d in reversed(deltas)] + ([self._table(f"base-{base}")] if base >= 0 else [])

    def probe(self, keyed: DataFrame) -> DataFrame:
        """``keyed``, which has ``md5``, with ``translated`` and ``known``: whether the key is stored."""
        given = [c for c in keyed.columns if c not in ("translated", "known")]
        found = keyed.select(*given, F.lit(None).cast("string").alias("translated"), F.lit(False).alias("known"))
        for part in self._parts():
            entries = part.select("md5", F.col("translated").alias("__t"), F.lit(True).alias("__here"))
            here = F.coalesce("__here", F.lit(False))
            found = found.join(bounded(entries), "md5", "left").select(
                *given, F.when(F.col("known"), F.col("translated")).when(here, F.col("__t")).alias("translated"),
                (F.col("known") | here).alias("known"))
        return found

    def entries(self) -> DataFrame:
        """All entries, each key once with its newest value."""
        rows = None
        for age, part in enumerate(self._parts()):
            some = part.select("md5", F.struct(F.lit(-age).alias("age"), "translated").alias("v"))
            rows = some if rows is None else rows.unionByName(some)
        if rows is None:
            return self.spark.createDataFrame([], SCHEMA)
        return rows.groupBy("md5").agg(F.max("v").alias("v")).select("md5", "v.translated")

    def upsert(self, new: DataFrame) -> None:
        """Store entries ``(md5, translated)``; of several values for a key the greatest is kept. A NULL key is none."""
        once = new.filter(F.col("md5").isNotNull()).groupBy("md5").agg(F.max("translated").alias("translated"))
        base, deltas = self._folders()
        number = max([base, *deltas]) + 1
        self._write(once.repartition(self.buckets, "md5"), f"delta-{number}")
        if len(deltas) + 1 >= self.fan:
            self.merge()

    def merge(self) -> None:
        """Merge all deltas into a new base. Files of a bucket meet the files of the same bucket only."""
        base, deltas = self._folders()
        if not deltas:
            return
        merged = None
        for part in self._parts():
            newer = part.select("md5", F.struct(F.lit(1).alias("here"), "translated").alias("a"))
            if merged is None:
                merged = newer
                continue
            older = newer.withColumnRenamed("a", "b")
            merged = merged.join(older.hint("merge"), "md5", "full").select("md5", F.coalesce("a", "b").alias("a"))
        self._write(merged.select("md5", "a.translated"), f"base-{deltas[-1]}")

    def evict_poisoned(self, tokens: Sequence[str] = POISON) -> int:
        """Overwrite entries that carry placeholder tokens by none, so their texts are asked for again; how many."""
        bad = self.entries().filter(poisoned("translated", tokens=tokens)).select("md5", F.lit(None).cast("string").alias("translated"))
        held = bad.collect() if bad.limit(10_001).count() <= 10_000 else None
        count = len(held) if held is not None else bad.count()
        if count:
            self.upsert(bad if held is None else self.spark.createDataFrame(held, SCHEMA))
        return count


def lookup_stored(chunks: DataFrame, store: CacheStore, text: str = "text", mode: str = "foreign") -> DataFrame:
    """Adds ``md5``, ``translated`` and ``status`` (``hit``, ``miss`` or ``poisoned``) from a stored cache.

    Texts are made distinct first, so the store is probed once per text and a hot text costs one row.
    """
    keyed = chunks.withColumn("md5", tx.digest(text))
    distinct = keyed.filter(F.col("md5").isNotNull()).groupBy("md5").agg(F.max(text).alias("__text"))
    found = store.probe(distinct)
    bad = poisoned("translated", "__text" if mode == "foreign" else None)
    stored = F.col("known") & F.col("translated").isNotNull()
    status = F.when(~stored, "miss").when(bad, "poisoned").otherwise("hit")
    answers = found.select("md5", F.when(status == "hit", F.col("translated")).alias("translated"), status.alias("status"))
    return keyed.join(answers, "md5", "left").select(
        *chunks.columns, "md5", "translated", F.coalesce("status", F.lit("miss")).alias("status"))
