"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from corpusprep.catalog import QUERIES  # noqa: E402
from corpusprep.session import build_session  # noqa: E402

HEADLINE = (
    "residual_after_rewrite span_counts masked_text mask_roundtrip glossary_rewrite clean_text "
    "marker_hits residual_by_source chunk_text pack_batches page_buckets inherit_page monotone_filter "
    "window_filter tail_ranges merge_ranges dedupe_refs caption_lookahead split_in_order cache_misses "
    "translate_cached resolve_links sequence_audit missing_numbers error_summary export_chunks"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/documents.parquet").count()

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = run(name)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
