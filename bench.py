"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of the tables, ``BENCH_CPUS`` the local cores,
and ``BENCH_QUERIES`` (optional, with commas) the queries to run.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from workload.queries import QUERIES

HEADLINE = (
    "x1_example_job j1_inner j2_left j3_right j4_full j8_chain j8_star_left f1_filter_joined"
    " f2_filter_between c2_join_cardinality c3_key_overlap c6_unique c15_report"
    " d1_row_difference d1_equal_tables d3_cell_difference d4_verify_jobs g5_strings"
    " g11_correlated_pair g13_chain g14_chain_with_filter g15_first_rows s6_job_output"
).split()
REPEATS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        # A join whose smaller side has small partitions needs no sort.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start up and compile once, so that the first query is not charged for it.
    QUERIES["x1_example_job"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    scale = re.search(r"sf([0-9.]+)$", folder.rstrip("/"))
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, best of 3 runs each",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
