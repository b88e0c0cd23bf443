"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
"""

import json
import os
import sys
import time

from terralist.queries import QUERIES
from terralist.session import local_session

HEADLINE = [
    "wave_change_log", "historical_merge", "wave_classify", "standardize_source", "clean_listings",
    "potential_duplicate_counts", "potential_duplicates", "neighbourhood_ids", "component_ids",
    "comparables", "pair_scores_comparables", "pair_scores_neigh", "score_funnel",
    "description_clean", "tfidf_terms", "tfidf_top_similar", "vector_topk",
    "dedupe_rows", "row_counts", "price_histogram",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench")
    # The first query of a session pays for loading classes and compiling.
    QUERIES["wave_classify"](spark, folder).count()
    QUERIES["price_histogram"](spark, folder).count()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": folder.rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
