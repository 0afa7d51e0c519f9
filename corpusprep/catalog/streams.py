"""Streaming operators, run over all events and compared with their batch forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusprep.catalog.base import EV, marked_blocks, query, table
from corpusprep.catalog.events import MONOTONE
from corpusprep.session import shared_dir
from corpusprep.streaming.streams import stream_cache_misses, stream_monotone_filter


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a stream, whether the table is one file or a folder of part files."""
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")


@query("stream_cache_misses", "SELECT DISTINCT md5(props) AS md5, props AS text FROM events")
def cache_misses_of_stream(spark: SparkSession, sf: str) -> DataFrame:
    return stream_cache_misses(event_stream(spark, sf), shared_dir(spark, "misses"), "props")


@query("stream_monotone_filter", f"WITH {EV}, {MONOTONE} SELECT doc, pos, page FROM mono WHERE keep = 1")
def monotone_stream(spark: SparkSession, sf: str) -> DataFrame:
    blocks = marked_blocks(event_stream(spark, sf)).select("doc", "pos", "page")
    return stream_monotone_filter(blocks, shared_dir(spark, "monotone"), ["doc"])
