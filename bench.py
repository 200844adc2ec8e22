"""Headline timings. Prints one JSON line; reads $BENCH_SF_DIR on local[$BENCH_CPUS]."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plumbline.plans.queries import QUERIES, prepared  # noqa: E402

HEADLINE = [
    "feature_projection",
    "stratified_split",
    "stratified_folds",
    "kfold_shuffled",
    "keyless_split",
    "confusion_counts",
    "binary_metrics",
    "cv_mean_accuracy",
    "best_candidate",
    "feature_bins",
    "train_lr",
    "train_dt",
    "train_rf",
    "train_adaboost",
    "predict_rf",
    "tune_lr",
    "tune_dt",
]  # all with the full default parameters and grids; the other searches take too long for every round


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("plumbline-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()  # the session's own start is not timed
    seconds: dict[str, float] = {}

    def timed(name, run):
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("prepare", lambda: prepared(spark, sf_dir))  # split, folds and cache that the rest shares
    for name in HEADLINE:
        timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
