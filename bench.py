"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from tierwise.plans.catalog.registry import spark_queries  # noqa: E402

HEADLINE = [
    "csv_scan_nulls",
    "audit_report",
    "audit_iqr_outliers",
    "stratified_split",
    "stratified_folds",
    "quantile_clip",
    "mice_numeric",
    "ordinal_encode",
    "knn_join",
    "knn_join_blocks",
    "borderline_smote",
    "borderline_smote_blocks",
    "resample_allknn",
    "resample_ncr",
    "resample_tomek",
    "classification_metrics",
    "classification_metrics_by_run",
    "tiering_score",
    "threshold_grid",
    "threshold_recall_100",
    "stratify_risk",
    "tier_summary",
    "calibrate_isotonic",
    "shap_interventional",
    "shap_importance",
    "median_prune",
    "run_summary",
    "gbt_fit_score",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = spark_queries()
    chosen = sys.argv[1:] or HEADLINE
    # Session start-up is not part of any query.
    registered["tier_summary"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in chosen:
        begun = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begun, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
