"""Row types of the corpus tables."""

from __future__ import annotations

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType(), False),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
])

BLOCKS = T.StructType([
    T.StructField("doc", T.LongType(), False),
    T.StructField("pos", T.LongType(), False),
    T.StructField("text", T.StringType()),
    T.StructField("pages", T.ArrayType(T.IntegerType())),
])

RANGES = T.StructType([
    T.StructField("doc", T.LongType(), False),
    T.StructField("s", T.LongType(), False),
    T.StructField("e", T.LongType(), False),
    T.StructField("label", T.StringType()),
])

CACHE = T.StructType([
    T.StructField("md5", T.StringType(), False),
    T.StructField("translated", T.StringType()),
])

EDITS = T.StructType([
    T.StructField("rule_id", T.StringType(), False),
    T.StructField("ord", T.IntegerType(), False),
    T.StructField("kind", T.StringType(), False),
    T.StructField("pattern", T.StringType(), False),
    T.StructField("replacement", T.StringType()),
    T.StructField("stop", T.StringType()),
])

GLOSSARY = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("put", T.StringType()),
])

ASSETS = T.StructType([
    T.StructField("file_name", T.StringType(), False),
    T.StructField("source_path", T.StringType()),
    T.StructField("input_path", T.StringType()),
    T.StructField("processed_path", T.StringType()),
    T.StructField("prompt_path", T.StringType()),
    T.StructField("page_number", T.IntegerType()),
    T.StructField("asset_type", T.StringType()),
    T.StructField("caption", T.StringType()),
    T.StructField("prompt", T.StringType()),
])
