"""Two operators as Structured Streaming jobs.

New texts are told from known ones by Spark's own deduplication, whose state store is keyed by
digest. The page filter keeps its state per key in a ``KeyedState``: a state store would hand all
rows of a key to one task, while the filter's scans spread a hot key over many. Either way a batch
touches the state of its own keys only, and one that is replayed after a failure has the same
result, so results are exactly-once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.functions import text as tx
from corpusprep.operators.scan import Cutting, Run, chosen, in_stretches, running
from corpusprep.streaming.state import KeyedState

TASK_DIGESTS = 1_000_000

# Spark's settings for state on disk, of which a batch saves what it has changed.
ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started here keep their state in RocksDB, unless the session names a provider."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    given = spark.conf.get(provider, None)
    mine = {} if given and "HDFSBacked" not in given else ON_DISK
    before = {k: spark.conf.get(k, None) for k in mine}
    for k, v in mine.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _ensure(spark: SparkSession, path: str, schema: T.StructType) -> None:
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/batch=-1")


def once_per_task(rows: DataFrame, key: str) -> DataFrame:
    """Rows without most repeats of ``key`` within a task, so a hot key is thinned before a shuffle.

    What a task remembers is bounded; repeats beyond it, and those of other tasks, stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            fresh = []
            for value in batch.column(key).to_pylist():
                fresh.append(value not in seen)
                seen.add(value)
            if len(seen) > TASK_DIGESTS:
                seen.clear()
            yield batch.filter(pa.array(fresh, pa.bool_()))

    return rows.mapInArrow(run, rows.schema)


def stream_cache_misses(chunks: DataFrame, folder: str, text: str) -> DataFrame:
    """Texts the stream has not brought before, each once: ``(md5, text)``.

    A text counts as new by its digest alone, so one that arrives late is not
    lost: there is no watermark, and digests do not expire. A NULL text is new once.
    """
    spark = chunks.sparkSession
    schema = T.StructType([T.StructField("md5", T.StringType()), T.StructField("text", T.StringType())])
    out = f"{folder}/misses"
    fresh = once_per_task(
        chunks.select(tx.digest(text).alias("md5"), F.col(text).alias("text")), "md5").dropDuplicates(["md5"])
    with state_on_disk(spark):
        query = (
            fresh.writeStream.format("parquet").outputMode("append")
            .option("path", out).option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(schema).parquet(out)


def stream_monotone_filter(
    blocks: DataFrame, folder: str, keys: Sequence[str], pos: str = "pos", page: str = "page",
    jump: int = 10, bits: Cutting = None,
) -> DataFrame:
    """The monotone page filter over blocks that keep arriving.

    Every block is written once with ``status`` ``kept``, ``dropped`` or
    ``late``; the kept ones are returned. The state of a key is its highest
    page, whether it is suppressing, and its last position; blocks at or before
    that position are late and not judged. A batch reads and writes the state of
    its own keys, and uses the segmented scan, so a hot key is spread over tasks
    in the stream as well.
    """
    spark = blocks.sparkSession
    keys = list(keys)
    judged, states = f"{folder}/judged", f"{folder}/state"
    key_fields = [blocks.schema[k] for k in keys]
    state = T.StructType([*key_fields, T.StructField("mx", T.LongType()),
                          T.StructField("keep", T.IntegerType()), T.StructField("at", T.LongType())])
    rows = T.StructType([*blocks.schema, T.StructField("status", T.StringType()),
                         T.StructField("keep", T.IntegerType())])
    _ensure(spark, judged, rows)
    kept = KeyedState(states, state, keys)

    def judge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        old = kept.before(batch, number)
        # The state enters the scans as a row right after its last position.
        carried = old.select(
            *keys, F.col("mx").alias("__value"), F.col("keep").alias("__keep0"),
            F.lit(1).alias("__state"), (F.col("at") * 2 + 1).alias("__at"))
        arrived = batch.select(
            "*", F.col(page).cast("bigint").alias("__value"), F.lit(0).alias("__state"),
            (F.col(pos) * 2).alias("__at"))
        both = arrived.unionByName(carried, allowMissingColumns=True)
        cutting = chosen(both, keys, bits)
        placed = running(in_stretches(both, "__at", cutting), keys, "__at", {
            "__ahead": Run("max", F.col("__state"), inclusive=False, backward=True)}, cutting)
        late = (F.col("__state") == 0) & (F.coalesce("__ahead", F.lit(0)) == 1)
        # Late blocks stay in the rows but have no say in the scans.
        heard = placed.withColumns({"__late": late, "__value": F.when(~late, F.col("__value"))})
        highest = running(heard, keys, "__at", {
            "__mx": Run("max", F.col("__value"), inclusive=False)}, cutting)
        decided = F.when(F.col("__state") == 1, F.col("__keep0")).when(
            F.col("__value").isNotNull(),
            F.when(F.col("__value") < F.col("__mx") - jump, 0).otherwise(1))
        done = running(highest, keys, "__at", {"keep": Run("last", decided)}, cutting)
        status = F.when(F.col("__late"), "late").when(
            F.coalesce("keep", F.lit(1)) == 1, "kept").otherwise("dropped")
        _write(done.filter("__state = 0").withColumn("status", status).select(*rows.names),
               judged, number)

        # The next state comes from the written rows, not from a second run of the batch.
        new = session.read.schema(rows).parquet(f"{judged}/batch={number}").filter("status <> 'late'")
        facts = new.select(*keys, F.col(page).cast("bigint").alias("mx"), "keep",
                           F.col(pos).cast("bigint").alias("at")).unionByName(old)
        kept.write(facts.groupBy(*keys).agg(
            F.max("mx").alias("mx"), F.max_by("keep", "at").alias("keep"), F.max("at").alias("at")), number)

    _run(blocks, f"{folder}/checkpoint", judge)
    done = spark.read.schema(rows).parquet(judged)
    return done.filter("status = 'kept'").select(*blocks.columns)


def _write(df: DataFrame, path: str, number: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={number}")


def _run(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Process everything that is there, then stop."""
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
