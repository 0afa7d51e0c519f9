"""Reading documents and assets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.operators.lookup import estimated_bytes

# Suffixes of supported illustrations.
IMAGE_SUFFIXES = (".png", ".jpg", ".jpeg", ".webp", ".tif", ".tiff")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files: ``(doc_id, path, text)``; the id is a hash of the path."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return files.select(F.xxhash64("path").alias("doc_id"), "path", "text")


def read_assets(spark: SparkSession, path: str, suffixes: Sequence[str] = IMAGE_SUFFIXES) -> DataFrame:
    """Files with a supported suffix, in any case: ``(path, length)``; contents stay unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return with_suffix(files.select("path", "length"), "path", suffixes)


def with_suffix(rows: DataFrame, name: str, suffixes: Sequence[str]) -> DataFrame:
    suffix = F.lower(F.regexp_extract(name, r"(\.[^./]*)$", 1))
    return rows.filter(suffix.isin(*suffixes))


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Hash a table over all cores if it is too small to fill them by its file splits.

    Large tables come back as they are: their splits already outnumber the cores,
    and a shuffle would only cost.
    """
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if estimated_bytes(rows) >= cores * split:
        return rows
    return rows.repartition(cores, *keys)
