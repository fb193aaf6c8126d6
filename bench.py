"""Headline queries: one JSON line with seconds per query (median after one warm-up)."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wattloom.catalog import QUERIES  # noqa: E402
from wattloom.session import get_session  # noqa: E402

HEADLINE = [
    "k02_build_features", "a07_hourly_profile", "a09_appliance_realism", "a11_daily_stats",
    "a15_validate_feature", "w03_temporal_split", "w04_contiguous_folds", "m02_linear_regression",
    "m07_evaluate", "m08_paired_t_test", "m10_cv_stability", "m12_learning_curve",
    "m14_permutation_importance", "m15_feature_power", "a17_shared_density", "st01_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = get_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
