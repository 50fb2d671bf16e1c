"""Operators on the k centroids: seeding, means, pairing, displacement."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spheremeans.functions.exact import limb_sums, mean_of, with_limbs
from spheremeans.functions.geo import distance_km, is_located
from spheremeans.operators.sampling import lowest_copies, lowest_keys, lowest_places

def sample_seeds(
    points: DataFrame, k: int, seed: int | None = 1, key: str | None = None, draw: str = "places"
) -> list[tuple[float, float]]:
    """Pick k starting centroids; a seed of None picks differently each time.

    With a unique ``key`` the k first rows in seeded order are taken. Without one ``draw`` says
    what is picked: ``"places"``, distinct ones, or ``"rows"``, so that a place is the
    likelier the more rows it has and can come more than once. Fewer candidates than k is an error.
    The first seeds of a larger k are those of a smaller one.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if draw not in ("places", "rows"):
        raise ValueError(f"unknown draw {draw!r}")
    if seed is None:
        seed = random.randrange(1 << 31)
    located = points.filter(is_located("latitude", "longitude"))
    if key:
        rows = lowest_keys(located, k, seed, key)
    else:
        rows = (lowest_places if draw == "places" else lowest_copies)(located, k, seed)
    if len(rows) < k:
        raise ValueError(f"only {len(rows)} points to pick {k} centroids from")
    return [(r["latitude"], r["longitude"]) for r in rows]


def seed_centroids(
    points: DataFrame, k: int, seed: int = 1, key: str | None = "point_id", draw: str = "places"
) -> DataFrame:
    """The seeds of ``sample_seeds`` as a centroid table."""
    seeds = sample_seeds(points, k, seed, key, draw)
    rows = [(i, lat, lon) for i, (lat, lon) in enumerate(seeds)]
    return points.sparkSession.createDataFrame(rows, "cluster_id int, latitude double, longitude double")


def cluster_means(assigned: DataFrame, label: str = "cluster_id", exact: bool = False) -> DataFrame:
    """Mean of degrees and number of points per cluster.

    Each task folds its points into at most one row per cluster before the
    shuffle, so the size of a cluster does not matter. ``exact`` sums are the same for any
    order of the points, to the last digit of the means.
    """
    if exact:
        sums = with_limbs(assigned.select(label, "latitude", "longitude"), "latitude", "longitude")
        sums = sums.groupBy(label).agg(F.count(F.lit(1)).alias("n_points"), *limb_sums("latitude", "longitude"))
        return sums.select(label, mean_of("latitude", "n_points"), mean_of("longitude", "n_points"), "n_points")
    return assigned.groupBy(label).agg(
        F.avg("latitude").alias("latitude"),
        F.avg("longitude").alias("longitude"),
        F.count(F.lit(1)).alias("n_points"),
    )


def cluster_sizes(assigned: DataFrame, label: str = "cluster_id") -> DataFrame:
    return assigned.groupBy(label).agg(F.count(F.lit(1)).alias("n_points"))


def number_centroids(centroids: DataFrame, *order: str) -> DataFrame:
    """Ids from 0 in a stated order. For centroid tables only: one task sorts them."""
    rank = F.row_number().over(Window.orderBy(*(order or ("latitude", "longitude"))))
    return centroids.withColumn("cluster_id", (rank - 1).cast("int"))


def pair_centroids(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new place of each cluster, side by side.

    A cluster missing on one side keeps the place it has on the other.
    """
    left = old.select(
        "cluster_id",
        F.col("latitude").alias("old_latitude"),
        F.col("longitude").alias("old_longitude"),
    )
    right = new.select(
        "cluster_id",
        F.col("latitude").alias("new_latitude"),
        F.col("longitude").alias("new_longitude"),
    )
    paired = left.join(right, "cluster_id", "full")
    return paired.select(
        "cluster_id",
        *[
            F.coalesce(f"{side}_{axis}", f"{other}_{axis}").alias(f"{side}_{axis}")
            for side, other in (("old", "new"), ("new", "old"))
            for axis in ("latitude", "longitude")
        ],
    )


def centroid_moves(old: DataFrame, new: DataFrame, metric: str = "euclidean") -> DataFrame:
    """Kilometres each centroid moved."""
    moved = distance_km(metric, "old_latitude", "old_longitude", "new_latitude", "new_longitude")
    return pair_centroids(old, new).withColumn("displacement_km", moved)


def displacement(old: DataFrame, new: DataFrame, metric: str = "euclidean") -> DataFrame:
    """Total movement of all centroids, one row."""
    return centroid_moves(old, new, metric).agg(F.sum("displacement_km").alias("displacement_km"))
