"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.  A warm-up run comes first.  The training-data
operators, where they are there, run once each and are not in the sum."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from pyspark.sql import SparkSession

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = ["gold_stack", "dim_join_roles", "dedup_tiebreak", "row_hash", "partition_hash", "diff_iud", "dq_pk", "dq_non_negative", "latest_per_key", "metric_rollup"]


def main() -> None:
    spark = SparkSession.builder.master(f"local[{CPUS}]").config("spark.sql.shuffle.partitions", CPUS).config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    from cairn.queries import QUERIES

    took = {}
    for name in HEADLINE:
        runs = []
        for _ in range(4):
            began = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        took[name] = round(sorted(runs[1:])[1], 3)
    total = round(sum(took.values()), 3)
    try:
        from cairn.llm.queries import QUERIES as training
    except ModuleNotFoundError as e:
        if not e.name.startswith("cairn.llm"):
            raise
        training = {}
    for name in sorted(training, key=lambda n: int(n[2:].split("_")[0])):
        began = time.perf_counter()
        training[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline queries, sum of medians", "value": total, "unit": "sec", "queries": took, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
