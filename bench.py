"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from trellis.plans.catalog import QUERIES
from trellis.plans.graphs import hand_over
from trellis.plans.registry import Tables
from trellis.session import clear_scratch, local_session

HEADLINE = [
    "graph_counts", "pagerank", "louvain", "betweenness_centrality", "connected_components", "sssp_weighted", "bfs", "triangle_count",
    "k_core", "label_propagation", "friend_of_friend_risk", "match_path", "shared_neighbor_pairs", "equal_amount_cycle",
    "graph_upsert", "sum_avg_min_max", "join_feature_tables", "point_in_time_features", "median_by_group", "bigrams_topk",
    "embedding_topk", "knn_classify_3", "stream_windowed_counts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus), memory=os.environ.get("BENCH_MEMORY", "12g"))
    times = {}
    started = time.time()
    hand_over(Tables(spark, folder))
    times["build_graphs"] = round(time.time() - started, 3)
    for name in HEADLINE:
        started = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - started, 3)
    clear_scratch(spark)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
