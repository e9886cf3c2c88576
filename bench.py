"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

``value`` is the sum over the queries. The sample table that several queries
read is written once beforehand and reported as ``prepare_samples``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "clean_samples", "split_date_range", "split_date_proportion", "split_hash", "split_report", "merge_samples",
    "missing_profile", "numeric_profile", "categorical_profile", "concentration", "duplicate_ids", "default_rates",
    "cross_default", "crosstab_3d", "iv_numeric", "mono_bins", "iv_categorical", "woe_capped", "woe_replace",
    "cont_profile", "cont_profile_tree", "robust_bounds", "recode", "nominal_profile", "psi_numeric",
    "psi_categorical", "psi_score", "psi_bins_retrain", "feature_stats", "corr_matrix", "select_features",
    "rule_lift", "ks", "auc_ks_by_group", "decile_table", "score_bands", "lift_curve", "roc_points",
    "score_transfer", "band_table_3way", "pareto_trials", "boosting_scores", "feature_importance", "csv_roundtrip",
)


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("riskweave-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    import checks
    from riskweave.sources import demo

    queries, _ = checks.load()
    times: dict[str, float] = {}
    began = time.perf_counter()
    demo.samples_table(spark, sf_dir)
    times["prepare_samples"] = round(time.perf_counter() - began, 3)
    for name in HEADLINE:
        began = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
