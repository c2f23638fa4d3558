"""Headline queries, timed. Prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores,
``BENCH_REPEATS`` the timed runs after one warm-up (the median is reported).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeretrieve.registry import QUERIES  # noqa: E402
from lakeretrieve.session import build_session  # noqa: E402

HEADLINES = os.environ.get("BENCH_QUERIES", "").split() or [
    "v09_knn",
    "v12_knn_batch_cosine",
    "v12_knn_batch_l2",
    "v12_knn_batch_tiles",
    "v13_knn_metadata_filter",
    "v16_mmr",
    "v22_build_vector_index",
    "v23_search_vector_index",
    "t03_match_phrase",
    "t05_match_any",
    "t07_search_batch_phrase",
    "t07_search_batch_all",
    "t07_search_batch_any",
    "t08_build_postings",
    "t09_postings_search_phrase",
    "t09_postings_search_all",
    "t09_postings_search_any",
    "h03_hybrid_all",
    "h03_hybrid_any",
    "h03_hybrid_phrase",
    "h04_cross_table_content",
    "k01_mget",
    "k02_mset",
    "k02_change_log",
    "k05_store_documents",
    "b10_get_files",
    "c05_last_messages",
    "c11_transcript",
    "r01_context",
    "q05_render_groups",
    "p02_top_n",
    "p06_group_aggregate",
    "p11_joins",
    "s01_stream_upserts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = build_session("bench", cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    seconds: dict[str, float] = {}
    for name in HEADLINES:
        runs = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
