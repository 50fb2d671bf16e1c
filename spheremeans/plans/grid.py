"""Fits for several k and metrics together, as a runtime comparison needs them.

A pass labels each point by all fits that still go on, in one scan and one projection, and
averages by (fit, cluster) after one shuffle. Fits whose centroids are equal, such as the
metrics of one k until the first of them stops, share a label. There are as many
passes as the longest fit needs.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spheremeans.functions.geo import METRICS, moves_km
from spheremeans.operators.assign import MAX_CENTROIDS, Centroids, label_by_each, place
from spheremeans.operators.centroids import sample_seeds
from spheremeans.plans.history import History
from spheremeans.plans.kmeans import DEFAULT_TOLERANCE_KM, PLACE, Model, advance, begin, ended, goes_on


def grid_pass(placed: DataFrame, models: Sequence[Centroids]) -> DataFrame:
    """Means and sizes: model, cluster_id (null: points without a place), latitude, longitude, n_points."""
    labelled = label_by_each(placed, list(PLACE), models)
    return labelled.groupBy("model", "cluster_id").agg(
        F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"), F.count(F.lit(1)).alias("n_points")
    )


def fit_grid(
    points: DataFrame,
    ks: Sequence[int],
    metrics: Sequence[str] = ("euclidean", "haversine"),
    *,
    tol_km: float = DEFAULT_TOLERANCE_KM,
    max_iter: int | None = 100,
    seed: int | None = 1,
    key: str | None = None,
    draw: str = "places",
    cache: str = "memory",
) -> dict[tuple[int, str], Model]:
    """The models that ``fit`` would give for each k and metric, from shared passes.

    Each k starts from the first of the seeds of the largest, as it does alone.
    """
    if not ks or min(ks) < 1 or sum(set(ks)) * len(metrics) > MAX_CENTROIDS:
        raise ValueError(f"every k must be at least 1, and all fits together have at most {MAX_CENTROIDS} centroids")
    if unknown := [m for m in metrics if m not in METRICS]:
        raise ValueError(f"unknown metric {unknown[0]!r}, expected one of {sorted(METRICS)}")
    if cache not in ("none", "memory"):
        raise ValueError(f"unknown cache {cache!r}")
    spark, read = points.sparkSession, points
    if cache == "memory":
        read = points.select(*dict.fromkeys([*PLACE, *([key] if key else [])])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        seeds = sample_seeds(read, max(ks), seed, key, draw)
        logs = {(k, m): History(spark) for k in dict.fromkeys(ks) for m in dict.fromkeys(metrics)}
        states = {name: begin(log, seeds[: name[0]]) for name, log in logs.items()}
        placed = place(read.select(*PLACE))
        while going := [name for name, state in states.items() if goes_on(state, tol_km, max_iter)]:
            began = time.perf_counter()
            numbers = {c: j for j, c in enumerate(dict.fromkeys(tuple(states[name]["centroids"]) for name in going))}
            found: list[dict] = [{} for _ in numbers]
            for r in grid_pass(placed, list(numbers)).collect():
                found[r["model"]][r["cluster_id"]] = r.asDict()
            seconds = time.perf_counter() - began
            for name in going:
                old = states[name]["centroids"]
                own = found[numbers[tuple(old)]]
                used = [i for i in own if i is not None]
                means = np.array([(own[i]["latitude"], own[i]["longitude"]) for i in used]).reshape(-1, 2)
                moved = moves_km(name[1], np.array([old[i] for i in used]).reshape(-1, 2), means)
                for i, km in zip(used, moved.tolist(), strict=True):
                    own[i]["displacement_km"] = km
                advance(states[name], logs[name], own, seconds)
    finally:
        if cache == "memory":
            read.unpersist()
    return {
        name: Model(spark=spark, points=points, log=logs[name], **ended(state, tol_km)) for name, state in states.items()
    }
