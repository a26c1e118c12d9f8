"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query wall times (seconds)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans import catalog  # noqa: E402
from quarry.session import get_session  # noqa: E402

HEADLINE = [
    "edge_sentiment", "word_stats", "summary_stats", "common_words", "entity_sentiments",
    "word_contexts", "node_sentiment", "graph_overview",
    "price_features", "csad", "ttm_eps", "regression_fit",
    "describe_columns", "quantile_bins", "knn_impute",
    "graph_distances", "betweenness",
    "root_split", "nearest_goal_paths", "assignment_best_response",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="quarry-bench")
    catalog.load_all()
    if unknown := [n for n in HEADLINE if n not in catalog.QUERIES]:
        raise SystemExit(f"unknown queries: {unknown}")
    names = HEADLINE
    times = {}
    for n in names:
        t0 = time.time()
        df = catalog.QUERIES[n](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
