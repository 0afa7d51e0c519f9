"""Keyed state of a stream as a log of segments, merged in levels.

Every micro-batch writes the state of the keys it has changed, dealt into buckets by a hash of
the key. ``fan`` segments of a level are merged into one of the next, so a key is rewritten once per
level and there are at most ``(fan - 1) * levels`` segments to read. Which segments hold the state
before a batch follows from the batch's number alone: they are its digits in base ``fan``. A batch
that is replayed therefore reads what it read before and overwrites what it wrote.

Segments that have been merged are deleted one batch later, when the batch that merged them can
no longer be replayed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAN = 4
BUCKETS = 64


class KeyedState:
    """``schema`` has the keys and the values; a key's latest row is its state."""

    def __init__(self, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = BUCKETS, fan: int = FAN):
        self.path, self.schema, self.keys = path, schema, list(keys)
        self.buckets, self.fan = buckets, fan
        self.values = [f.name for f in schema if f.name not in self.keys]

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def segments(self, number: int) -> list[tuple[int, int]]:
        """``(level, last batch)`` of the segments before batch ``number``, oldest first."""
        levels, size = 0, 1
        while size * self.fan <= number:
            levels, size = levels + 1, size * self.fan
        out, upto = [], 0
        for level in range(levels, -1, -1):
            for _ in range((number - upto) // self.fan**level):
                upto += self.fan**level
                out.append((level, upto - 1))
        return out

    def folder(self, level: int, last: int) -> str:
        return f"{self.path}/level={level}/last={last}"

    def _latest(self, spark: SparkSession, segments: Sequence[tuple[int, int]], buckets: Sequence[int] | None) -> DataFrame:
        fields = [*self.schema, T.StructField("last", T.LongType()), T.StructField("bucket", T.IntegerType())]
        if not segments:
            return spark.createDataFrame([], T.StructType(fields)).drop("last")
        read = spark.read.schema(T.StructType(fields)).option("basePath", self.path)
        rows = read.parquet(*[self.folder(*s) for s in segments])
        if buckets is not None:
            rows = rows.filter(F.col("bucket").isin(*buckets))
        # A key has a row per segment at most, so this needs no sort.
        return rows.groupBy("bucket", *self.keys).agg(
            F.max_by(F.struct(*self.values), "last").alias("__v")).select(*self.keys, "bucket", "__v.*")

    def before(self, batch: DataFrame, number: int) -> DataFrame:
        """The state of the batch's keys before it; buckets without any of them are not read."""
        spark = batch.sparkSession
        touched = batch.select(*self.keys).distinct().withColumn("__bucket", self.bucket())
        numbers = [r[0] for r in touched.select("__bucket").distinct().collect()]
        old = self._latest(spark, self.segments(number), numbers).drop("bucket")
        same = [old[k].eqNullSafe(touched[k]) for k in self.keys]
        return old.join(touched, same, "left_semi").select(*self.schema.names)

    def write(self, changed: DataFrame, number: int) -> None:
        """Keep the state of the keys a batch has changed, and merge the segments that are due."""
        spark = changed.sparkSession
        rows = changed.select(*self.schema.names).withColumn("bucket", self.bucket())
        self._put(rows, 0, number)
        size, level = self.fan, 1
        while (number + 1) % size == 0:
            step = size // self.fan
            parts = [(level - 1, number - step * i) for i in range(self.fan)]
            self._put(self._latest(spark, parts, None), level, number)
            size, level = size * self.fan, level + 1
        self._drop_merged(spark, number)

    def _put(self, rows: DataFrame, level: int, last: int) -> None:
        placed = rows.repartition("bucket")
        placed.write.mode("overwrite").partitionBy("bucket").parquet(self.folder(level, last))

    def _drop_merged(self, spark: SparkSession, number: int) -> None:
        """Delete what earlier batches have merged; this batch's own merges stay until the next."""
        live = {self.folder(*s) for s in self.segments(number)}
        fs_path = spark._jvm.org.apache.hadoop.fs.Path
        fs = fs_path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        for level in fs.listStatus(fs_path(self.path)):
            for segment in fs.listStatus(level.getPath()):
                name = f"{self.path}/{level.getPath().getName()}/{segment.getPath().getName()}"
                last = int(name.rsplit("=", 1)[1]) if "=" in name.rsplit("/", 1)[1] else number
                if last < number and name not in live:
                    fs.delete(segment.getPath(), True)
