"""Time the headline queries: one JSON line with seconds per query.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores, BENCH_QUERIES an optional comma-separated choice.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

HEADLINE = [
    "comparables_lookup",
    "comparables_features",
    "train_lookup_merge",
    "prepare_units",
    "split_prepared",
    "drop_outliers",
    "latest_per_key",
    "dedup_units",
    "exact_quantiles",
    "profile",
    "impute_median",
    "onehot_topn",
    "target_encode",
    "lag_features",
    "lag_whole_table",
    "detrend_deg1",
    "text_stats",
    "text_polarity",
    "lsa",
    "metric_regression_all",
    "metric_auc_multiclass",
    "price_bands",
    "interval_by_key",
    "batch_confidence",
    "linear_fit",
    "knn_predict",
    "knn_property",
    "gbt_predict",
    "smote",
    "stream_score",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from gable.plans import QUERIES
    from gable.runtime import build_session

    spark = build_session("bench", f"local[{cpus}]", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # One small query loads classes, so that the first timing is not the JVM's start.
    QUERIES["comparables_features"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
