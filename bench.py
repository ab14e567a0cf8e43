"""Time the headline queries: one JSON line with seconds per query (median of BENCH_RUNS after a warm-up)."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tarmac.contract import registry  # noqa: E402
from tarmac.session import build_session  # noqa: E402

HEADLINE = [
    "delay_profile",
    "drop_flagged",
    "remove_duplicates",
    "fill_median",
    "impute_mean_all",
    "describe_by_group",
    "corr_matrix",
    "corr_matrix_wide",
    "duplicate_count",
    "iqr_outliers",
    "generate_features",
    "label_encode",
    "one_hot",
    "standard_scale",
    "train_test_split",
    "stratified_kfold",
    "undersample",
    "oversample",
    "kfold_after_oversample",
    "smote",
    "smote_tiled",
    "knn_join",
    "knn_join_tiled",
    "histogram",
    "box_stats_by_group",
    "kde",
    "anova",
    "levene",
    "kruskal_wallis",
    "mann_whitney",
    "friedman",
    "shapiro",
    "pairwise_t",
    "pca",
    "load_and_clean",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4)))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session("bench", cpus)
    seconds: dict[str, float] = {}
    for name in names:
        timings = []
        for i in range(runs + 1):
            start = time.perf_counter()
            registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            if i:
                timings.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(timings), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
