"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelwright.plans.catalog import CATALOG  # noqa: E402
from panelwright.session import local_session  # noqa: E402

HEADLINE = ["panel_base", "rolling_all", "target_encode_oof", "roc_auc", "slice_metrics", "describe", "corr_pairs",
            "iqr_outliers", "split_candidates", "score_batch", "quality_report", "threshold_f1", "brier_ece",
            "impute_median", "scale_standard", "request_violations", "label_top_share", "histogram"]


def run(query, spark, sf) -> float:
    start = time.perf_counter()
    query.run(spark, sf).write.format("noop").mode("overwrite").save()     # every row, nothing to the driver
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        run(CATALOG[name], spark, sf)                                       # warm-up
        seconds[name] = round(statistics.median(run(CATALOG[name], spark, sf) for _ in range(repeats)), 3)
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": sf.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
