"""Headline timings; prints one JSON line.

Each query runs twice into a sink that reads every row; the better time counts
(planning included, session start not).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from queryset import inputs  # noqa: E402
from queryset.spark_queries import QUERIES  # noqa: E402
from veilspark.plans.run import run  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "detect_all", "detect_cells", "gazetteer_entities", "detection_summary", "proximity_pairs",
    "pair_risk", "inferred_patterns_documents", "row_risk_documents", "row_risk", "graph_stats",
    "graph_edges", "components", "top_degree", "reid_risk", "graph_top_nodes", "mask_spans",
    "mask_patterns", "mask_full_documents", "mask_full", "report_row",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("veilspark-bench")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(action) -> float:
    best = None
    for _ in range(2):
        start = time.perf_counter()
        action()
        spent = time.perf_counter() - start
        best = spent if best is None else min(best, spent)
    return round(best, 3)


def whole_job(spark: SparkSession) -> None:
    out = tempfile.mkdtemp(prefix="run-")
    docs = inputs.documents(spark, SF_DIR)
    done = run(spark, docs, out, key="row_id", masked_format="parquet")
    if not done.success:
        raise RuntimeError(done.error)


def main() -> None:
    spark = session()
    times = {
        name: seconds(
            lambda q=QUERIES[name]: q(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        )
        for name in HEADLINE
    }
    times["whole_job"] = seconds(lambda: whole_job(spark))
    rows = inputs.table(spark, SF_DIR, "documents").count()
    print(json.dumps({
        "metric": "total of headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "documents": rows,
        "whole_job_rows_per_sec": round(rows / times["whole_job"], 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
