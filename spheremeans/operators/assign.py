"""Nearest centroid of each point by chord distance, the lowest id winning ties.

The centroids travel inside the plan, so assigning is a projection: no join, no
shuffle, no key needed on the points. Three forms give the same labels. Up to
``UNROLL_LIMIT`` centroids the k distances are written out as expressions and
stay in generated code. Beyond it the generated method passes the size the JVM
agrees to compile, and a vectorised function takes over, which scans the centroids
and, from ``INDEX_FROM`` of them, searches a tree.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spheremeans.functions.geo import EARTH_RADIUS_KM, cartesian
from spheremeans.operators.index import tree_search

Centroids = Sequence[tuple[float, float]]

# Measured: from 20 up the vectorised form is as fast, and from 24 the generated
# method is only interpreted, seven times slower. Wide rows reach that sooner.
UNROLL_LIMIT = 16

# Measured: the tree is as fast as a matrix product at about 2,000 centroids.
INDEX_FROM = 2048

# Centroids are held by the driver and shipped with each stage, 24 bytes apiece.
MAX_CENTROIDS = 1_000_000

# Distances a Python worker holds at once; about what a processor cache does.
_BLOCK_CELLS = 1 << 17

# Dot products this near each other do not tell which centroid is nearer. Their
# rounding error is a hundred times smaller.
_CLOSE_KM2 = 1e-6


def centroid_list(centroids: DataFrame | Centroids) -> list[tuple[float, float]]:
    """Centroids in id order, checked for number and for missing values."""
    if isinstance(centroids, DataFrame):
        rows = (
            centroids.select("cluster_id", "latitude", "longitude")
            .limit(MAX_CENTROIDS + 1)
            .collect()
        )
        rows.sort(key=lambda r: r["cluster_id"])
        if [r["cluster_id"] for r in rows] != list(range(len(rows))):
            raise ValueError("cluster_id must run from 0 without gaps")
        pairs = [(r["latitude"], r["longitude"]) for r in rows]
    else:
        pairs = [(lat, lon) for lat, lon in centroids]
    if not pairs:
        raise ValueError("at least one centroid is needed")
    if len(pairs) > MAX_CENTROIDS:
        raise ValueError(f"more than {MAX_CENTROIDS} centroids")
    if any(v is None or not np.isfinite(v) for pair in pairs for v in pair):
        raise ValueError("centroids must be finite numbers")
    return [(float(lat), float(lon)) for lat, lon in pairs]


def assign(
    points: DataFrame,
    centroids: DataFrame | Centroids,
    label: str = "cluster_id",
    distance: str | None = None,
    unroll_limit: int = UNROLL_LIMIT,
    index_from: int = INDEX_FROM,
) -> DataFrame:
    """Add the nearest centroid's id, and optionally its distance in km.

    A point with a null, NaN or infinite coordinate gets a null label.
    """
    pairs = centroid_list(centroids)
    return label_placed(place(points), points.columns, pairs, label, distance, unroll_limit, index_from)


def place(points: DataFrame) -> DataFrame:
    """Add the Cartesian position ``_x, _y, _z``, NaN where a coordinate is missing.

    Non-null positions spare the generated code a null check per operation.
    """
    nan = F.lit(float("nan"))
    x, y, z = cartesian(F.coalesce("latitude", nan), F.coalesce("longitude", nan))
    return points.select("*", x.alias("_x"), y.alias("_y"), z.alias("_z"))


def label_placed(
    placed: DataFrame,
    kept: list[str],
    pairs: Centroids,
    label: str = "cluster_id",
    distance: str | None = None,
    unroll_limit: int = UNROLL_LIMIT,
    index_from: int = INDEX_FROM,
) -> DataFrame:
    """Label points that already have their position, keeping only columns ``kept``.

    A filter or join on the label would be pushed below the projections, and
    repeat all k distances in each branch of the predicate. The generator at the
    end stops it there.
    """
    kept = [f"`{name}`" for name in kept]
    if len(pairs) <= unroll_limit:
        wide, nearest = _unrolled(placed, kept, pairs), _first_at_best(len(pairs))
    else:
        wide, nearest = _vectorised(placed, kept, pairs, index_from), "_found.label"
    found = f"'{label}', {nearest}"
    if distance:
        found += f", '{distance}', nanvl(_best, CAST(NULL AS DOUBLE))"
    return wide.selectExpr(*kept, f"inline(array(named_struct({found})))")


def _unrolled(placed: DataFrame, kept: list[str], pairs: Centroids) -> DataFrame:
    centres = positions(np.asarray(pairs, dtype=np.float64)).tolist()
    distances = [f"{_chord_sql(centre)} AS _d{i}" for i, centre in enumerate(centres)]
    names = [f"_d{i}" for i in range(len(pairs))]
    best = f"least({', '.join(names)})" if len(names) > 1 else names[0]
    return placed.selectExpr(*kept, *distances).selectExpr("*", f"{best} AS _best")


def _first_at_best(k: int) -> str:
    branches = " ".join(f"WHEN _d{i} = _best THEN {i}" for i in range(k))
    return f"CASE WHEN isnan(_best) THEN NULL {branches} END"


def _chord_sql(centre: Sequence[float]) -> str:
    """Distance from (_x, _y, _z) to one centroid.

    The position is the one the vectorised form uses, and the operations come in the same
    order, so a tie in one form is a tie in the other.
    """
    squares = [f"(_{axis} - ({v!r}D)) * (_{axis} - ({v!r}D))" for axis, v in zip("xyz", centre, strict=True)]
    return f"sqrt({' + '.join(squares)})"


def _vectorised(placed: DataFrame, kept: list[str], pairs: Centroids, index_from: int) -> DataFrame:
    places, ids = distinct_places(pairs)
    nearest = _nearest_one(searcher(places, index_from), ids)
    found = placed.select("*", nearest("_x", "_y", "_z").alias("_found"))
    return found.selectExpr(*kept, "_found", "_found.best AS _best")


def searcher(places: np.ndarray, index_from: int = INDEX_FROM):
    """A function from points (finite rows of x, y, z) to the row of the nearest place and its distance."""
    centres = positions(places)
    if len(centres) < index_from:
        return _scan(centres)
    search = tree_search(centres)
    return lambda points: search(points)[:2]


def distinct_places(pairs: Centroids) -> tuple[np.ndarray, np.ndarray]:
    """Centroids without later copies of the same place, which never win, and their ids."""
    first: dict[tuple[float, float], int] = {}
    for i, pair in enumerate(pairs):
        first.setdefault(tuple(pair), i)
    return np.asarray(list(first), dtype=np.float64), np.asarray(list(first.values()))


# The functions below are sent to workers that may not have this package, so they
# refer to nothing in it but their own arguments.


def _scan(centres: np.ndarray):
    """The largest dot product marks the nearest centroid, and costs one matrix product.

    It is less exact than a distance, so rows whose two best products are about
    equal are decided by their distances.
    """
    across = np.ascontiguousarray(centres.T)
    rows_at_once = max(1, _BLOCK_CELLS // len(centres))
    close_km2 = _CLOSE_KM2

    def scan(points):
        label, best = np.zeros(len(points), dtype=np.int64), np.empty(len(points))
        for start in range(0, len(points), rows_at_once):
            some = points[start : start + rows_at_once]
            products = some @ across
            first = products.argmax(axis=1)
            top = products[np.arange(len(some)), first]
            distance = np.sqrt(np.square(some - centres[first]).sum(axis=1))
            rivals = (products >= (top - close_km2)[:, None]).sum(axis=1)
            close = np.flatnonzero(rivals > 1)
            if len(close):
                squares = 0.0
                for axis in range(3):
                    squares = squares + np.square(some[close, axis, None] - centres[:, axis])
                exact = np.sqrt(squares)
                first[close] = exact.argmin(axis=1)
                distance[close] = exact.min(axis=1)
            label[start : start + rows_at_once] = first
            best[start : start + rows_at_once] = distance
        return label, best

    return scan


def _nearest_one(search, ids: np.ndarray):
    @F.pandas_udf("label int, best double")
    def nearest(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for axes in batches:
            points = np.column_stack([axis.to_numpy() for axis in axes])
            placed = np.isfinite(points).all(axis=1)
            label, best = np.zeros(len(points), dtype=np.int64), np.full(len(points), np.nan)
            label[placed], best[placed] = search(points[placed])
            labels = pd.Series(ids[label]).astype("Int32").mask(~placed)
            yield pd.DataFrame({"label": labels, "best": best})

    return nearest


def _nearest_each(searches: list, ids: list[np.ndarray]):
    """The label in each of several sets of centroids, -1 without a place."""

    @F.pandas_udf("array<int>")
    def nearest(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for axes in batches:
            points = np.column_stack([axis.to_numpy() for axis in axes])
            placed = np.isfinite(points).all(axis=1)
            labels = np.full((len(points), len(searches)), -1, dtype=np.int32)
            for j, search in enumerate(searches):
                labels[placed, j] = ids[j][search(points[placed])[0]]
            yield pd.Series(list(labels))

    return nearest


def label_by_each(
    placed: DataFrame, kept: list[str], models: Sequence[Centroids], label: str = "cluster_id", model: str = "model"
) -> DataFrame:
    """Rows (kept columns, number of the model, label): a point once for each set of centroids.

    Sets are written out as expressions while they have ``UNROLL_LIMIT`` centroids together; all
    others are searched by one function, so a point goes to Python once at most.
    """
    unrolled, room = [], UNROLL_LIMIT
    for j in sorted(range(len(models)), key=lambda j: len(models[j])):
        room -= len(models[j])
        if room >= 0:
            unrolled.append(j)
    rest = [j for j in range(len(models)) if j not in unrolled]
    kept = [f"`{name}`" for name in kept]
    labels, found = {}, placed
    if rest:
        sets = [distinct_places(models[j]) for j in rest]
        nearest = _nearest_each([searcher(places) for places, _ in sets], [ids for _, ids in sets])
        found = found.select("*", nearest("_x", "_y", "_z").alias("_labels"))
        labels = {j: f"nullif(_labels[{n}], -1)" for n, j in enumerate(rest)}
    carried = [*kept, *(["_labels"] if rest else [])]
    distances, lowest = [], []
    for j in unrolled:
        names = [f"_d{j}_{i}" for i in range(len(models[j]))]
        centres = positions(np.asarray(models[j], dtype=np.float64)).tolist()
        distances += [f"{_chord_sql(c)} AS {n}" for c, n in zip(centres, names, strict=True)]
        lowest.append(f"{f'least({', '.join(names)})' if len(names) > 1 else names[0]} AS _best{j}")
        branches = " ".join(f"WHEN {n} = _best{j} THEN {i}" for i, n in enumerate(names))
        labels[j] = f"CASE WHEN isnan(_best{j}) THEN NULL {branches} END"
    found = found.selectExpr(*carried, *distances).selectExpr("*", *lowest)
    every = ", ".join(f"CAST({labels[j]} AS INT)" for j in range(len(models)))
    return found.selectExpr(*kept, f"posexplode(array({every})) AS ({model}, {label})")


def nearest_two(centres: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of the nearest centre, its distance, and that of the runner-up (infinite if there is none)."""
    rows_at_once = max(1, _BLOCK_CELLS // len(centres))
    label = np.zeros(len(points), dtype=np.int64)
    best, second = np.empty(len(points)), np.empty(len(points))
    for start in range(0, len(points), rows_at_once):
        cut = slice(start, start + rows_at_once)
        squares = 0.0
        for axis in range(3):
            squares = squares + np.square(points[cut, axis, None] - centres[:, axis])
        d = np.sqrt(squares)
        rows = np.arange(len(d))
        label[cut] = d.argmin(axis=1)
        best[cut] = d[rows, label[cut]]
        d[rows, label[cut]] = np.inf
        second[cut] = d.min(axis=1)
    return label, best, second


def positions(pairs: np.ndarray) -> np.ndarray:
    """Cartesian positions in kilometres of rows of (latitude, longitude)."""
    phi, lam = np.radians(pairs[:, 0]), np.radians(pairs[:, 1])
    unit = np.column_stack([np.cos(phi) * np.cos(lam), np.cos(phi) * np.sin(lam), np.sin(phi)])
    return EARTH_RADIUS_KM * unit
