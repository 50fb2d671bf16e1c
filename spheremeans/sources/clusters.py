"""Readers for saved clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spheremeans.operators.clusters import cluster_points

# Fixed value: the layout of a saved cluster line, brackets around each list. Ours number
# the chunks of a cluster at the end; other lines are whole clusters.
SAVED_LINE = r"closest_centroid=(\d+), lat_list=\[([^\]]*)\], long_list=\[([^\]]*)\](?:, chunk=(\d+))?"


def _numbers(inner: Column) -> Column:
    """``'1.5', '2.0'`` to doubles; the quotes are optional."""
    bare = F.translate(inner, "[]' ", "")
    return F.when(bare == "", F.array().cast("array<double>")).otherwise(
        F.transform(F.split(bare, ","), lambda v: v.try_cast("double"))
    )


def read_cluster_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``cluster_id, chunk, lat_list, long_list`` from saved lines; chunk is null if a line has none."""
    lines = spark.read.option("lineSep", "\n").text(path)
    found = [F.regexp_extract("value", SAVED_LINE, i) for i in (1, 2, 3, 4)]
    return lines.filter(F.col("value").rlike(SAVED_LINE)).select(
        found[0].cast("int").alias("cluster_id"),
        found[3].try_cast("bigint").alias("chunk"),
        _numbers(found[1]).alias("lat_list"),
        _numbers(found[2]).alias("long_list"),
    )


def read_cluster_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``cluster_id, chunk, lat_list, long_list`` from the list CSV; chunk is null without the column."""
    raw = (
        spark.read.schema("closest_centroid int, lat_list string, long_list string, chunk bigint")
        .options(header=True, sep="|", maxCharsPerColumn=-1)
        .csv(path)
    )
    return raw.select(
        F.col("closest_centroid").alias("cluster_id"),
        "chunk",
        _numbers(F.col("lat_list")).alias("lat_list"),
        _numbers(F.col("long_list")).alias("long_list"),
    )


def read_cluster_points(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Saved lines as one row per point: ``cluster_id, latitude, longitude``."""
    points = cluster_points(read_cluster_text(spark, path))
    return points.select("cluster_id", "latitude", "longitude")
