"""Times headline queries and k-means fits; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the number of threads.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from spheremeans import fit
    from spheremeans.catalog.fixtures import point_view
    from spheremeans.catalog.queries import QUERIES

    seconds: dict[str, float] = {}
    detail: dict[str, dict] = {}

    def timed(name, work):
        start = time.perf_counter()
        result = work()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    QUERIES["cluster_mean"](spark, SF_DIR).collect()  # start-up

    for name in QUERIES:
        timed(name, lambda name=name: drain(QUERIES[name](spark, SF_DIR)))

    # The factors of the published runtime analysis: k, metric and caching.
    points = point_view(spark, SF_DIR, "event_points")
    for k in (2, 5, 6, 20):
        for metric in ("euclidean", "haversine"):
            for cache in ("memory", "none"):
                name = f"fit_k{k}_{metric}_{cache}"
                model = timed(
                    name,
                    lambda k=k, metric=metric, cache=cache: fit(
                        points, k, metric=metric, key="point_id", cache=cache
                    ),
                )
                detail[name] = {
                    "iterations": model.iterations,
                    "sec_per_iteration": round(seconds[name] / model.iterations, 3),
                }

    scale = re.search(r"sf([\d.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else SF_DIR,
                "fits": detail,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
