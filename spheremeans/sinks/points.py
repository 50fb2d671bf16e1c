"""Writers. Every file is written by the tasks that hold the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_clean_points(points: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``latitude|longitude`` text, a header in every part file."""
    points.select("latitude", "longitude").write.mode(mode).options(header=True, sep="|").csv(path)


def write_assignments(
    assigned: DataFrame, path: str, layout: str = "partitioned", mode: str = "errorifexists"
) -> None:
    """Labelled points as parquet.

    ``partitioned`` makes one folder per cluster. Rows are rebalanced first, which
    fills files to size and splits a cluster that outgrows one, at the price of a
    shuffle. ``flat`` writes where the rows are, with no shuffle.
    """
    if layout == "partitioned":
        assigned.hint("rebalance", F.col("cluster_id")).write.mode(mode).partitionBy(
            "cluster_id"
        ).parquet(path)
    elif layout == "flat":
        assigned.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"unknown layout {layout!r}, expected 'partitioned' or 'flat'")


def list_text(values: Column | str) -> Column:
    """A list of numbers as ``['1.5', '2.0']``."""
    texts = F.transform(values, lambda v: v.cast("string"))
    inner = F.when(F.size(texts) > 0, F.concat(F.lit("'"), F.array_join(texts, "', '"), F.lit("'")))
    return F.concat(F.lit("["), F.coalesce(inner, F.lit("")), F.lit("]"))


def write_cluster_csv(lists: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``closest_centroid|lat_list|long_list|chunk``, a line per cluster chunk, in order over the files."""
    lists.orderBy("cluster_id", "chunk").select(
        F.col("cluster_id").alias("closest_centroid"),
        list_text("lat_list").alias("lat_list"),
        list_text("long_list").alias("long_list"),
        "chunk",
    ).write.mode(mode).options(
        header=True, sep="|", maxCharsPerColumn=-1
    ).csv(path)


def write_cluster_text(lists: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One ``Row(closest_centroid=…, lat_list=[…], long_list=[…], chunk=…)`` line per chunk, in order."""
    line = F.concat(
        F.lit("Row(closest_centroid="),
        F.col("cluster_id").cast("string"),
        F.lit(", lat_list="),
        list_text("lat_list"),
        F.lit(", long_list="),
        list_text("long_list"),
        F.lit(", chunk="),
        F.col("chunk").cast("string"),
        F.lit(")"),
    )
    lists.orderBy("cluster_id", "chunk").select(line.alias("value")).write.mode(mode).text(path)
