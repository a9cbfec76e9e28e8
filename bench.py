"""Time the headline queries; prints one JSON line.

Each query is run once to warm up and then timed writing to the ``noop`` sink, so that
every row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from feedloom.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = (
    "normalize_generic_json",
    "normalize_mixed_mappings",
    "normalize_typed_json",
    "json_path_props",
    "lexicon_sentiment_default",
    "lexicon_sentiment_custom",
    "sentiment_responses_fallback",
    "embedding_responses_checked",
    "hash_tokens",
    "hash_embedding_16",
    "hash_embedding_384",
    "document_ids",
    "latest_write_per_key",
    "upsert_index",
    "upsert_summary",
    "source_run_metrics",
    "fetch_outcomes_by_source",
    "knn_top5",
    "knn_of_many_queries",
    "search_one_query",
    "search_many_queries",
    "search_reply_envelope",
    "index_count_by_source",
    "stream_ingest",
)


def main() -> None:
    spark = build_session(
        "feedloom-bench",
        master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    from feedloom.plans.catalogue import QUERIES

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        timings = []
        for _ in range(1 + RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(timings[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
