"""Time the headline queries on the tables in $BENCH_SF_DIR with $BENCH_CPUS cores; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from hearthline.catalog import QUERIES

HEADLINES = [
    "profile_table", "describe_numeric", "describe_lineitem", "quantile_edges", "clean_table", "cleaning_report",
    "validate_ranges", "fit_median", "preprocess_fit_transform", "preprocess_transform",
    "ville_one_hot", "lookup_label_codes", "engineer_all",
    "stratified_split", "kfold_assign", "regression_metrics", "cv_summary",
    "fit_linear", "cross_validate", "train_evaluate", "fit_forest",
    "batch_score", "audit_rows", "audit_event_counts", "audit_tail", "stream_audit_counts", "stream_score",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = session(cpus)
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors
    seconds = {}
    for name in names:
        start = time.monotonic()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - start, 3)
    out = {"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
           "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cpus}
    if "batch_score" in seconds:
        rows = spark.read.parquet(f"{folder}/orders.parquet").count()
        out["scored_rows_per_sec"] = round(rows / seconds["batch_score"])
    print(json.dumps(out))


if __name__ == "__main__":
    main()
