"""Map data of clusters at any size: counts by cell and cluster for each zoom level.

A level has 2**zoom by 2**zoom cells, so what a map draws is bounded by the map, not by the
points. Points are counted once, in the cells of the last level; the other levels are sums of those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_ZOOM = 12


def _cell(name: str, low: float, span: float, zoom: int) -> Column:
    """Number of the cell, from the south or west; off the map at the border."""
    at = F.floor((F.col(name) - low) / span * (1 << zoom))
    return F.greatest(F.lit(0), F.least(F.lit((1 << zoom) - 1), at)).cast("int")


def map_pyramid(assigned: DataFrame, max_zoom: int = 8, label: str = "cluster_id") -> DataFrame:
    """zoom, cell_row, cell_column, cluster, n_points, share (of the cell's points), and the mean place.

    Points without a label are left out. One scan; what is shuffled are partial counts, at most
    clusters x cells rows of a task.
    """
    if not 0 <= max_zoom <= MAX_ZOOM:
        raise ValueError(f"max_zoom must be between 0 and {MAX_ZOOM}")
    finest = (
        assigned.where(F.col(label).isNotNull())
        .groupBy(
            _cell("latitude", -90.0, 180.0, max_zoom).alias("r"),
            _cell("longitude", -180.0, 360.0, max_zoom).alias("c"),
            F.col(label).alias(label),
        )
        .agg(F.count(F.lit(1)).alias("n"), F.sum("latitude").alias("lat"), F.sum("longitude").alias("lon"))
    )
    levels = finest.withColumn("zoom", F.explode(F.sequence(F.lit(0), F.lit(max_zoom))))
    up = F.lit(max_zoom) - F.col("zoom")
    cells = levels.groupBy(
        "zoom", F.call_function("shiftright", "r", up).alias("cell_row"), F.call_function("shiftright", "c", up).alias("cell_column"), label
    ).agg(F.sum("n").alias("n_points"), F.sum("lat").alias("lat"), F.sum("lon").alias("lon"))
    place = ["zoom", "cell_row", "cell_column"]
    whole = F.sum("n_points").over(Window.partitionBy(*place))  # a cell has a row for each cluster at most
    return cells.select(
        *place, label, "n_points", (F.col("n_points") / whole).alias("share"),
        (F.col("lat") / F.col("n_points")).alias("latitude"), (F.col("lon") / F.col("n_points")).alias("longitude"),
    )
