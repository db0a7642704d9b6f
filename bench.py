"""Times every query on the tables in ``$BENCH_SF_DIR`` and prints one JSON line.

Results go to Spark's no-op sink, so that whole tables are computed but not
brought to the driver. Each query runs twice and the shorter run counts; the
model queries run once.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from stridecast.workloads.queries import FORESTS, QUERIES as CHECKED

QUERIES = CHECKED | FORESTS

MODEL_QUERIES = ("rf_", "forest_", "feature_importance", "training_error")


def timed(query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stridecast-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="stridecast-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed(QUERIES["eval_levels"], spark, sf_dir)
    seconds = {}
    for name in chosen:
        runs = 1 if name.startswith(MODEL_QUERIES) else 2
        seconds[name] = round(min(timed(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
