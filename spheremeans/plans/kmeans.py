"""Lloyd's k-means on the sphere.

Each iteration is one Spark job over the points: label them in a projection,
fold them to one row per cluster and task, shuffle those few rows. Only the k
centroids come back to the driver, and they enter the next iteration as
constants, so the plan never grows.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from spheremeans.config import new_path
from spheremeans.functions.geo import METRICS, distance_km, is_located
from spheremeans.operators.assign import (
    Centroids,
    assign,
    centroid_list,
    label_placed,
    place,
)
from spheremeans.operators.centroids import cluster_means, sample_seeds
from spheremeans.plans import tiles
from spheremeans.plans.history import History

# Fixed value: both jobs stop at a total movement of one kilometre.
DEFAULT_TOLERANCE_KM = 1.0

# Old places of up to so many centroids enter a pass as constants, those of more as a small table.
MOST_CONSTANTS = 64

PLACE = ("latitude", "longitude")
CENTROID_SCHEMA = "cluster_id int, latitude double, longitude double"


@dataclass
class Model:
    """What a fit returns.

    ``centroids`` are the final means. ``labelling_centroids`` are the means one
    step earlier, which produced the last labels and hence the reported clusters.
    """

    spark: SparkSession
    points: DataFrame
    centroids: list[tuple[float, float]]
    labelling_centroids: list[tuple[float, float]]
    converged: bool
    iterations: int
    n_unlocated: int
    log: History
    table_path: str | None = None

    def centroid_table(self) -> DataFrame:
        rows = [(i, lat, lon) for i, (lat, lon) in enumerate(self.centroids)]
        return self.spark.createDataFrame(rows, CENTROID_SCHEMA)

    def history(self) -> DataFrame:
        """One row per iteration and cluster; iteration 0 holds the seeds."""
        return self.log.frame()

    @property
    def records(self) -> list[tuple]:
        """The rows of ``history()`` by iteration and cluster."""
        return self.log.rows()

    def assignments(self) -> DataFrame:
        """The points with the labels of the last pass, unlocated points left out."""
        return assign(_located(self.points), self.labelling_centroids)

    def predict(self, points: DataFrame | None = None) -> DataFrame:
        """Points labelled by the final centroids."""
        return assign(_located(self.points if points is None else points), self.centroids)


def _located(points: DataFrame) -> DataFrame:
    return points.filter(is_located(*PLACE))


def step(
    points: DataFrame,
    centroids: DataFrame | Centroids,
    metric: str = "euclidean",
    float32_centroids: bool = False,
    exact: bool = False,
) -> DataFrame:
    """One Lloyd iteration: new mean, size and movement of each non-empty cluster.

    Points without a place are counted under a null ``cluster_id``.
    """
    build = _full_pass(points.select(*PLACE), metric, float32_centroids, exact)
    return build(centroid_list(centroids))


def _full_pass(places: DataFrame, metric: str, float32: bool, exact: bool) -> Callable[[Centroids], DataFrame]:
    """A pass over every point. What does not depend on the centroids is built once."""
    placed = place(places)
    finish = _finisher(metric, float32)

    def build(pairs: Centroids) -> DataFrame:
        return finish(cluster_means(label_placed(placed, list(PLACE), pairs), exact=exact), pairs)

    return build


def _finisher(metric: str, float32: bool) -> Callable[[DataFrame, Centroids], DataFrame]:
    """Adds each centroid's movement, looking up its old place in constant arrays."""
    moved = distance_km(metric, "old_latitude", "old_longitude", *PLACE)
    if float32:
        moved = moved.cast("float").cast("double")
    columns = ["cluster_id", "n_points", *PLACE, moved.alias("displacement_km")]

    def finish(means: DataFrame, pairs: Centroids) -> DataFrame:
        if len(pairs) > MOST_CONSTANTS:
            rows = [(i, lat, lon) for i, (lat, lon) in enumerate(pairs)]
            old = means.sparkSession.createDataFrame(rows, "_id int, old_latitude double, old_longitude double")
            means = means.join(F.broadcast(old), means["cluster_id"] == old["_id"], "left")
            if float32:
                means = means.withColumns({c: F.col(c).cast("float").cast("double") for c in PLACE})
            return means.select(*columns)
        mean = "CAST(CAST({0} AS FLOAT) AS DOUBLE) AS {0}" if float32 else "{0}"
        looked_up = [
            f"get(array({', '.join(f'{p[axis]!r}D' for p in pairs)}), cluster_id) AS old_{name}"
            for axis, name in enumerate(PLACE)
        ]
        return means.selectExpr(
            "cluster_id", "n_points", *[mean.format(c) for c in PLACE], *looked_up
        ).select(*columns)

    return finish


def fit(
    points: DataFrame,
    k: int | None = None,
    *,
    metric: str | None = None,
    tol_km: float = DEFAULT_TOLERANCE_KM,
    max_iter: int | None = 100,
    seed: int | None = 1,
    key: str | None = None,
    init: DataFrame | Centroids | None = None,
    draw: str = "places",
    cache: str = "memory",
    float32_centroids: bool | None = None,
    exact: bool | None = None,
    history: str | None = None,
    resume: str | None = None,
) -> Model:
    """Cluster ``points`` (double columns latitude, longitude) into k groups.

    Labels always follow chord distance; ``metric`` (euclidean if not given) only measures
    how far the centroids moved. The loop ends when that total is at most ``tol_km`` or after
    ``max_iter`` passes (None: no limit). A cluster left empty keeps its centroid.
    Seeds come from ``sample_seeds`` with ``seed``, ``key`` and ``draw``, or from ``init``.

    ``exact`` sums make the centroids independent of partitioning to their last digit, for
    about half more time in a pass; without, sums of doubles differ in the last digits.

    With ``history`` every iteration is appended to that folder as it ends, and the driver
    holds no more than two. ``resume`` names such a folder, takes k, metric and the last
    centroids from it, and goes on to the end that an uninterrupted fit of the same points would have had;
    ``max_iter`` counts the iterations before.

    ``cache`` says what the passes read: ``"none"`` the source itself, best for
    columnar files; ``"memory"`` cached coordinates, spilling to disk;
    ``"table"`` points written once to the shared folder, best for large text
    input; ``"tiles"`` points written once by map tile, after a shuffle, so that
    each pass only reads tiles on a cluster border, best when many passes over
    large data are expected. Written tables are kept for the caller to delete
    (``Model.table_path``).
    """
    if metric is not None and metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, expected one of {sorted(METRICS)}")
    if cache not in ("none", "memory", "table", "tiles"):
        raise ValueError(f"unknown cache {cache!r}")
    if max_iter is not None and max_iter < 1:
        raise ValueError("max_iter must be at least 1")
    if history and resume:
        raise ValueError("a resumed fit goes on in the folder it resumes from")
    spark = points.sparkSession
    state = None
    if resume:
        if init is not None:
            raise ValueError("a resumed fit has its centroids already")
        log, was = History.open(spark, resume)
        for name, value in (("k", k), ("metric", metric), ("float32_centroids", float32_centroids), ("exact", exact)):
            same = value == was[name] or METRICS.get(value, value) == METRICS.get(was[name])
            if value is not None and not same:
                raise ValueError(f"the fit to resume has {name}={was[name]!r}")
        metric, float32_centroids, exact = was["metric"], was["float32_centroids"], was["exact"]
        state = _resumed(log)
    metric, float32_centroids, exact = metric or "euclidean", bool(float32_centroids), bool(exact)

    table_path = None
    if cache == "table":
        table_path = new_path(spark, "points")
        points.write.parquet(table_path)
        points = spark.read.schema(points.schema).parquet(table_path)
    elif cache == "tiles":
        table_path = new_path(spark, "tiles")
        tiles.write_tiles(points, table_path)
        tiled = tiles.read_tiles(spark, table_path, points)
        points = tiled.select(*points.columns)

    if cache == "memory":  # before the seeds are drawn, so the source is read once
        reused = points.select(*dict.fromkeys([*PLACE, *([key] if key else [])]))
        reused = reused.persist(StorageLevel.MEMORY_AND_DISK)
    if state:
        centroids = state["centroids"]
    elif init is not None:
        centroids = centroid_list(init)
        if k is not None and k != len(centroids):
            raise ValueError(f"{len(centroids)} initial centroids for k={k}")
    elif k is None:
        raise ValueError("either k or init is needed")
    else:
        centroids = sample_seeds(reused if cache == "memory" else points, k, seed, key, draw)
    if not state:
        if history:
            log = History.create(spark, history, len(centroids), metric, float32_centroids, exact)
        else:
            log = History(spark)
        state = begin(log, centroids)

    try:
        if cache == "tiles":
            run = tiles.tiled_pass(tiled, metric, float32_centroids, exact)
        else:
            build = _full_pass((reused if cache == "memory" else points).select(*PLACE), metric, float32_centroids, exact)

            def run(pairs: Centroids) -> list[Row]:
                return build(pairs).collect()

        outcome = _loop(run, state, log, tol_km, max_iter)
    finally:
        if cache == "memory":
            reused.unpersist()
    return Model(spark=spark, points=points, table_path=table_path, log=log, **outcome)


def begin(log: History, centroids: list[tuple[float, float]]) -> dict:
    """The state before the first pass."""
    log.append(0, [(i, lat, lon, None, None, None) for i, (lat, lon) in enumerate(centroids)])
    return {"centroids": centroids, "labelling_centroids": centroids, "moved": float("inf"), "iterations": 0, "n_unlocated": 0}


def _resumed(log: History) -> dict:
    """The state after the last pass of a stored history."""
    rows, before = log.last()
    pairs = lambda rows: [(r["latitude"], r["longitude"]) for r in rows]
    moves = [r["displacement_km"] for r in rows]
    return {
        "centroids": pairs(rows),
        "labelling_centroids": pairs(before or rows),
        "moved": sum(moves) if before else float("inf"),
        "iterations": rows[0]["iteration"],
        "n_unlocated": rows[0]["n_unlocated"],
    }


def advance(state: dict, log: History, found: dict, seconds: float) -> None:
    """Takes one pass into the state: means, sizes and movements by cluster, unlocated points under None."""
    previous = state["centroids"]
    n_unlocated = found[None]["n_points"] if None in found else 0
    centroids, moved, rows = list(previous), 0.0, []
    for i, (lat, lon) in enumerate(previous):
        r = found.get(i)
        n, km = (r["n_points"], r["displacement_km"]) if r else (0, 0.0)
        if r:
            lat, lon = r["latitude"], r["longitude"]
        centroids[i] = (lat, lon)
        moved += km
        rows.append((i, lat, lon, n, km, seconds))
    state.update(
        centroids=centroids, labelling_centroids=previous, moved=moved, iterations=state["iterations"] + 1, n_unlocated=n_unlocated
    )
    log.append(state["iterations"], rows, n_unlocated)


def goes_on(state: dict, tol_km: float, max_iter: int | None) -> bool:
    return state["moved"] > tol_km and (max_iter is None or state["iterations"] < max_iter)


def ended(state: dict, tol_km: float) -> dict:
    """What a model tells of a fit."""
    out = dict(state)
    return out | {"converged": out.pop("moved") <= tol_km}


def _loop(
    run: Callable[[Centroids], list[Row]], state: dict, log: History, tol_km: float, max_iter: int | None
) -> dict:
    while goes_on(state, tol_km, max_iter):
        began = time.perf_counter()
        found = {r["cluster_id"]: r for r in run(state["centroids"])}
        advance(state, log, found, time.perf_counter() - began)
    return ended(state, tol_km)
