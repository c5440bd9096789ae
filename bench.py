"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "action_matrix",
    "association_rules",
    "association_diverse",
    "recommend_items",
    "reclist_packed",
    "auc_exact",
    "auc_by_user",
    "pr_points",
    "calib_isotonic",
    "history_features",
    "feature_information",
    "label_transfer",
    "keyword_search",
    "tfidf",
    "bm25",
    "pagerank",
    "vocab_counts",
    "nearest_vectors",
    "naive_bayes_predict",
    "month_snapshot",
    "stream_ctr",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from quillrank.catalog import QUERIES
    from quillrank.session import configure

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)) if cpus.isdigit() else "16")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    found = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(found.group(1)) if found else folder,
            }
        )
    )


if __name__ == "__main__":
    main()
