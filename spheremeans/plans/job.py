"""Command line: ``spark-submit job.py INPUT OUTPUT [METRIC [K]]``."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from spheremeans.functions.geo import METRICS
from spheremeans.operators.clusters import DEFAULT_CHUNK_ROWS, cluster_lists
from spheremeans.plans import cleaning
from spheremeans.plans.kmeans import DEFAULT_TOLERANCE_KM, Model, fit
from spheremeans.sinks import points as sinks
from spheremeans.sources.lines import read_pipe_points

READERS = {
    "pipe": read_pipe_points,
    "comma": cleaning.clean_comma_lines,
    "space": cleaning.clean_place_lines,
    "device": cleaning.clean_device_lines,
    "tab": cleaning.clean_tab_lines,
}


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Group latitude/longitude points into k clusters")
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("metric", nargs="?", default="euclidean")
    parser.add_argument("k", nargs="?", type=int, default=6)
    parser.add_argument("--format", choices=sorted(READERS), default="pipe")
    parser.add_argument(
        "--sink", choices=["assignments", "flat", "csv", "text"], default="assignments"
    )
    parser.add_argument("--tolerance-km", type=float, default=DEFAULT_TOLERANCE_KM)
    parser.add_argument("--max-iter", type=int, default=100, help="0: no limit")
    parser.add_argument("--allow-unconverged", action="store_true")
    parser.add_argument("--seed", type=int, default=1)
    parser.add_argument("--draw", choices=["places", "rows"], default="places", help="what seeds are picked from")
    parser.add_argument("--history", help="folder to append every iteration to (default: OUTPUT-history, at the end)")
    parser.add_argument("--resume", help="folder of a history to go on from, written with --history")
    parser.add_argument("--cache", choices=["none", "memory", "table", "tiles"], default="memory")
    parser.add_argument("--chunk-rows", type=int, default=DEFAULT_CHUNK_ROWS)
    args = parser.parse_args(argv)
    if args.k < 1:
        parser.error("invalid number of clusters")
    if args.metric not in METRICS:
        parser.error("invalid distance type")
    return args


def run(spark: SparkSession, argv: Sequence[str] | None = None) -> Model:
    """Read, cluster and write; returns the fitted model.

    Besides the clusters in OUTPUT come OUTPUT-centroids and OUTPUT-history, as parquet. A
    table written for the passes is deleted at the end.
    """
    args = _arguments(argv)
    model = fit(
        READERS[args.format](spark, args.input),
        args.k,
        metric=args.metric,
        tol_km=args.tolerance_km,
        max_iter=args.max_iter or None,
        seed=args.seed,
        draw=args.draw,
        cache=args.cache,
        history=args.history,
        resume=args.resume,
    )
    assigned = model.assignments()
    if args.sink == "assignments":
        sinks.write_assignments(assigned, args.output)
    elif args.sink == "flat":
        sinks.write_assignments(assigned, args.output, layout="flat")
    else:
        write = sinks.write_cluster_csv if args.sink == "csv" else sinks.write_cluster_text
        sizes = model.history().where(f"iteration = {model.iterations}").select("cluster_id", "n_points")
        write(cluster_lists(assigned, chunk_rows=args.chunk_rows, sizes=sizes), args.output)
    base = args.output.rstrip("/")
    model.centroid_table().write.parquet(f"{base}-centroids")
    if not (args.history or args.resume):
        model.history().write.parquet(f"{base}-history")
    if model.table_path:
        path = spark._jvm.org.apache.hadoop.fs.Path(model.table_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return model


def main() -> None:
    spark = SparkSession.builder.appName("spheremeans").getOrCreate()
    try:
        model = run(spark, sys.argv[1:])
    finally:
        spark.stop()
    if not model.converged and "--allow-unconverged" not in sys.argv:
        sys.exit(f"not converged after {model.iterations} iterations; the last state was written")


if __name__ == "__main__":
    main()
