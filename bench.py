"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built (which includes any lineage checkpoints it takes) and
fully executed into the no-op sink; the time covers both.  Prints one JSON
line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "species_counts",
    "coverage_by_tree",
    "pooled_no_extinct",
    "cells_distinct",
    "density_outlier_score",
    "outlier_summary",
    "records_without_outliers",
    "binned_counts",
    "pipeline_binned",
    "binned_no_dbscan",
    "quality_filter",
    "db_outlier",
    "knn_distance",
    "lof",
    "loop",
    "simple_cop",
    "isolation_forest",
    "kmeans_minus_minus",
    "em_outlier",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from occuflow.plans.queries import queries
    from occuflow.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2, app_name="occuflow-bench")
    qs = queries()
    names = [n for n in HEADLINE if n in qs]
    # Warm the JVM (class loading, codegen caches) on the smallest query.
    qs["species_names"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_headline_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
