"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from siftmine.plans.registry import QUERIES
from siftmine.session import build_session

HEADLINE = [
    "group_stats",
    "group_count_with_total",
    "partition_profile",
    "dense_ids",
    "item_pair_similarity",
    "item_cf_predict",
    "als_predict",
    "frequent_itemsets",
    "frequent_itemsets_orders",
    "son_itemsets",
    "itemset_report",
    "term_idf",
    "tfidf",
    "cluster_terms",
    "kmeans_lloyd",
    "kmeans_report",
    "lloyd_report_tf",
    "lloyd_report_terms_tf",
    "reservoir_stats",
    "bloom_audit",
    "stream_bloom",
    "stream_reservoir",
]


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="siftmine-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the executor's code paths before the clock runs.
    spark.read.parquet(f"{folder}/nation.parquet").groupBy("n_regionkey").count().collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
