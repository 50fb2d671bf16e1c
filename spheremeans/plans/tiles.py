"""K-means passes that skip the map tiles no cluster border crosses.

The points are written once, in folders by tile of the map, and summed up per smaller cell.
The map bounds the number of cells, so their sums are held by the driver. Far from the borders
every point of a cell has the same nearest centroid, which the cell's size and the distances
from its centre can prove: a point is at most the cell radius nearer to or farther from any
centroid than the centre is (Kanungo et al., 2002, use the same bound on a tree). What is left
of the gap is the cell's slack. It is carried over the passes and only lowered by how far
centroids moved (as Hamerly, 2010, does for points); cells whose slack ran out are judged
again. A settled cell enters the means through its sums. Only the points of the others are
labelled one by one, in one Spark job that reads their tiles alone, or in none where all
cells are settled. Labels and counts are those of a full pass.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from spheremeans.functions.exact import LIMBS, limb_names, limb_sums, means_of, with_limbs
from spheremeans.functions.geo import EARTH_RADIUS_KM, is_located, moves_km
from spheremeans.operators.assign import Centroids, distinct_places, label_placed, nearest_two, place, positions

TILE_DEGREES = 10.0
CELL_DEGREES = 0.5

# Bound on everything kept per cell, whatever the number of points.
MAX_CELLS = int(180 / CELL_DEGREES) * int(360 / CELL_DEGREES) + 1

# Kilometres that rounding may add to a distance, with a wide margin.
_ROUNDING_KM = 1e-6

_NO_PLACE = -1

_AXES = ("latitude", "longitude")


def _grid(degrees: float) -> Column:
    """Number of the grid square; coordinates off the map go to the border squares."""
    rows, columns = int(180 / degrees), int(360 / degrees)

    def index(name: str, half: float, count: int) -> Column:
        at = F.floor((F.col(name) + half) / degrees)
        return F.greatest(F.lit(0), F.least(at, F.lit(count - 1)))

    number = index("latitude", 90.0, rows) * columns + index("longitude", 180.0, columns)
    return F.when(is_located("latitude", "longitude"), number).otherwise(_NO_PLACE).cast("int")


def write_tiles(points: DataFrame, path: str) -> None:
    """Store points by tile. Rebalancing splits a tile that holds most of the points."""
    tiled = points.withColumns({"_tile": _grid(TILE_DEGREES), "_cell": _grid(CELL_DEGREES)})
    tiled.hint("rebalance", F.col("_tile")).sortWithinPartitions("_tile", "_cell").write.partitionBy(
        "_tile"
    ).parquet(path)


def read_tiles(spark: SparkSession, path: str, points: DataFrame) -> DataFrame:
    added = [StructField("_cell", IntegerType()), StructField("_tile", IntegerType())]
    return spark.read.schema(StructType([*points.schema.fields, *added])).parquet(path)


def _sum_names(exact: bool) -> list[str]:
    return [c for n in _AXES for c in limb_names(n)] if exact else [f"sum_{n}" for n in _AXES]


def _summed(points: DataFrame, exact: bool) -> tuple[DataFrame, list[Column]]:
    """Points with what is summed up, and the sums, named by ``_sum_names``."""
    if exact:
        return with_limbs(points, *_AXES), limb_sums(*_AXES)
    return points, [F.sum(n).alias(f"sum_{n}") for n in _AXES]


def summarise(tiled: DataFrame, exact: bool = False) -> DataFrame:
    """One row per cell in use: sums, count, centre and radius."""
    points, sums = _summed(tiled, exact)
    south, north, west, east = (F.col(c) for c in ("south", "north", "west", "east"))
    nearest_equator = F.when((south <= 0) & (north >= 0), 0.0).otherwise(
        F.least(F.abs(south), F.abs(north))
    )
    widest = F.when(F.greatest(F.abs(south), F.abs(north)) > 90.0, 1.0).otherwise(
        F.cos(F.radians(nearest_equator))
    )
    # From the centre along the meridian, then along the parallel.
    radius = EARTH_RADIUS_KM * F.radians((north - south) / 2 + widest * (east - west) / 2)
    return (
        points.groupBy("_tile", "_cell")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *sums,
            F.min("latitude").alias("south"),
            F.max("latitude").alias("north"),
            F.min("longitude").alias("west"),
            F.max("longitude").alias("east"),
        )
        .select(
            "_tile",
            "_cell",
            "n",
            *_sum_names(exact),
            ((south + north) / 2).alias("latitude"),
            ((west + east) / 2).alias("longitude"),
            radius.alias("radius_km"),
        )
    )


class Cells:
    """Sums and bounds of the cells in use, at most ``MAX_CELLS``, held by the driver."""

    def __init__(self, tiled: DataFrame, exact: bool = False) -> None:
        self.exact, self.columns = exact, _sum_names(exact)
        table = summarise(tiled, exact).toArrow()
        column = {n: table.column(n).to_numpy(zero_copy_only=False) for n in table.column_names}
        self.tile, self.cell, self.n = column["_tile"], column["_cell"], column["n"]
        # Only the cell of points without a place has no sums.
        self.sums = np.column_stack([table.column(n).fill_null(0).to_numpy() for n in self.columns])
        self.placed = self.cell != _NO_PLACE
        centre = np.column_stack([column["latitude"], column["longitude"]])
        self.centre, self.radius = positions(np.where(self.placed[:, None], centre, 0.0)), column["radius_km"]
        self.label = np.full(len(self.cell), -1)
        self.slack = np.where(self.placed, -np.inf, np.inf)
        self.judged = 0
        self._last: np.ndarray | None = None

    def settle(self, pairs: Centroids) -> None:
        """Labels and slacks for these centroids; carried where they last.

        A positive slack says that all points of the cell have the cell's label.
        """
        now = np.asarray(pairs, dtype=np.float64)
        places, ids = distinct_places(pairs)
        stale = self.placed.copy()
        # While some centroids share a place, all but one of them are left out of the bounds.
        if self._last is not None and len(places) == len(pairs):
            moved = moves_km("euclidean", self._last, now)
            most = np.sort(moved)[-2:]
            # The farthest move of the others is the second farthest for whom moved farthest.
            others = np.where(moved == most[-1], most[0], most[-1]) if len(moved) > 1 else np.zeros(1)
            settled = self.placed & (self.slack > 0)
            self.slack[settled] -= (moved + others)[self.label[settled]] + _ROUNDING_KM
            stale &= self.slack <= 0
        self._last = now if len(places) == len(pairs) else None
        which = np.flatnonzero(stale)
        label, best, second = nearest_two(positions(places), self.centre[which])
        self.label[which] = ids[label]
        self.slack[which] = second - best - 2 * self.radius[which] - _ROUNDING_KM
        self.judged += len(which)

    def contested(self) -> np.ndarray:
        return self.placed & (self.slack <= 0)

    def totals(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Number of points and sums of the settled cells of each cluster."""
        settled = self.placed & (self.slack > 0)
        label, n = self.label[settled], np.zeros(k, dtype=np.int64)
        np.add.at(n, label, self.n[settled])
        sums = np.zeros((k, len(self.columns)), dtype=self.sums.dtype)
        np.add.at(sums, label, self.sums[settled])
        return n, sums

    def means(self, n: np.ndarray, sums: np.ndarray) -> np.ndarray:
        if not self.exact:
            return sums / n[:, None]
        return np.column_stack([means_of(sums[:, :LIMBS], n), means_of(sums[:, LIMBS:], n)])


def border_points(tiled: DataFrame, tile: np.ndarray, cell: np.ndarray) -> DataFrame:
    """The points of some cells. Their tiles are constants, so other folders are not read."""
    # At most MAX_CELLS rows of one integer, so broadcasting is safe at any scale.
    wanted = tiled.sparkSession.createDataFrame(pa.table({"_cell": pa.array(cell, pa.int32())}))
    inside = tiled.where(F.col("_tile").isin(sorted({int(t) for t in tile})))
    return inside.join(F.broadcast(wanted), "_cell", "left_semi").select("latitude", "longitude")


def tiled_pass(tiled: DataFrame, metric: str, float32: bool, exact: bool = False) -> Callable[[Centroids], list[dict]]:
    """A pass over the cells, and over the points of contested cells only."""
    cells = Cells(tiled, exact)

    def run(pairs: Centroids) -> list[dict]:
        cells.settle(pairs)
        n, sums = cells.totals(len(pairs))
        contested = cells.contested()
        if contested.any():
            points = border_points(tiled, cells.tile[contested], cells.cell[contested])
            labelled = label_placed(place(points), ["latitude", "longitude"], pairs)
            summed, aggregates = _summed(labelled, exact)
            for r in summed.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"), *aggregates).collect():
                n[r["cluster_id"]] += r["n"]
                sums[r["cluster_id"]] += [r[c] for c in cells.columns]
        old, used = np.asarray(pairs, dtype=np.float64), np.flatnonzero(n)
        means = cells.means(n[used], sums[used])
        if float32:
            means = means.astype(np.float32).astype(np.float64)
        moved = moves_km(metric, old[used], means) if len(used) else []
        rows = [
            {"cluster_id": int(i), "n_points": int(n[i]), "latitude": float(m[0]), "longitude": float(m[1]), "displacement_km": float(km)}
            for i, m, km in zip(used, means, moved, strict=True)
        ]
        nowhere = int(cells.n[~cells.placed].sum())
        return rows + ([{"cluster_id": None, "n_points": nowhere}] if nowhere else [])

    run.cells = cells
    return run
