"""Writing chunks and manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.operators.scan import Cutting, numbered


def write_manifest(assets: DataFrame, folder: str) -> None:
    """The asset table as JSON lines and as CSV with a header."""
    assets.write.mode("overwrite").json(f"{folder}/json")
    assets.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder}/csv")


def chunk_manifest(chunks: DataFrame, keys: Sequence[str], stem: str = "doc", bits: Cutting = None,
                   builds: DataFrame | None = None) -> DataFrame:
    """Index, page range, status and file name of each chunk, numbered per document from 1.

    ``builds`` holds build results ``(*keys, start_page, error)``, one per chunk: an
    error makes the status ``FAILED`` and is shown; without one it is ``OK``.
    """
    span = F.format_string("%03d-%03d", "start_page", "end_page")
    name = F.concat(F.lit(f"{stem}"), F.concat_ws("_", *keys), F.lit("_p"), span, F.lit(".md"))
    unique = chunks.select(*keys, "start_page", "end_page").distinct().withColumn(
        "__at", F.col("start_page").cast("bigint"))
    rows = numbered(unique, keys, "__at", "idx", 1, bits)
    if builds is None:
        rows = rows.withColumn("error", F.lit(None).cast("string"))
    else:
        rows = rows.join(builds.select(*keys, "start_page", "error"), [*keys, "start_page"], "left")
    status = F.when(F.col("error").isNull(), "OK").otherwise("FAILED")
    return rows.select(
        *keys, "idx", span.alias("page_range"), status.alias("status"), name.alias("name"), "error")


def write_chunk_manifest(manifest: DataFrame, path: str) -> None:
    manifest.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def write_chunks(chunks: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Chunk texts in columnar files, clustered on the document and its first page.

    Rows are ranged on ``(keys, start_page, part)``, so files are of even size
    whatever a document's size, and readers prune by file statistics.
    """
    order = [*keys, "start_page", "part"]
    chunks.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def write_chunk_folders(chunks: DataFrame, path: str, keys: Sequence[str]) -> None:
    """One folder per document and chunk, for corpora with few documents."""
    chunks.write.mode("overwrite").partitionBy(*keys, "start_page").parquet(path)
