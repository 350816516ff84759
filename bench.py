"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data set, ``BENCH_CPUS`` the number of local threads. Every query is built and
run from the source tables; nothing is shared between them. One small run first loads the JVM classes.
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from pyspark.sql import SparkSession  # noqa: E402

from catalog.queries import QUERIES  # noqa: E402

HEADLINE = ("unique_names", "cleaning_map", "source_profile", "token_sort_ratio", "cluster_names", "resolve_payees")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # The rounds compile more classes than the default cache holds.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(key: str, path: str) -> float:
        start = time.perf_counter()
        QUERIES[key](spark, path).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        run("resolve_payees", small)
    times = {key: run(key, sf_dir) for key in HEADLINE}
    result = {
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
