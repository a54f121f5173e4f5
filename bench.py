"""Time the headline queries: one JSON line.

The feature chain is timed from the source files on, forgetting all tables written
before. The analyses are timed on the cleaned feature table, which is written once,
as in use. BENCH_SF_DIR and BENCH_CPUS choose data and cores, BENCH_RUNS the runs
of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from check import spark_session
from pavilion.plans.catalog import catalog, forget_tables

CHAIN = [
    "innings_rollup",
    "rolling_home_away",
    "rolling_batting",
    "final_diff",
    "zscore_filter",
]
ANALYSES = [
    "rank_first_ranged",
    "msd_univariate",
    "msd_pairs",
    "class_density",
    "univariate_logit",
    "corr_matrix",
    "fold_metrics",
    "standardise",
    "pca_variance",
    "lda_covariance",
    "knn_predict",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = spark_session(int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8)))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    queries = catalog()

    def once(name: str, cold: bool) -> float:
        if cold:
            forget_tables()
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    def median(name: str, cold: bool) -> float:
        return round(statistics.median(once(name, cold) for _ in range(runs)), 3)

    once("final_diff", True)  # warm-up of the JVM
    times = {name: median(name, True) for name in CHAIN}
    times |= {name: median(name, False) for name in ANALYSES}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
