import math
import re
import struct

import pytest
from pyspark.sql import functions as F
from test_assign import SCHEMA, chord, plan, some_points

from spheremeans import assign, fit, fit_grid, step
from spheremeans.config import new_path
from spheremeans.operators import sampling
from spheremeans.operators.assign import place
from spheremeans.operators.centroids import (
    centroid_moves,
    displacement,
    sample_seeds,
    seed_centroids,
)
from spheremeans.plans import grid, history, tiles
from spheremeans.plans.grid import grid_pass

HUBS = [(40.0, -100.0), (50.0, 10.0), (-25.0, 135.0), (-15.0, -50.0)]


@pytest.fixture(scope="module")
def points(spark):
    """Hubs with scatter, a third of all points on one spot, and some without a place."""
    hub = F.element_at(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in HUBS]),
                       (F.col("id") % 4 + 1).cast("int"))
    df = spark.range(0, 3000, 1, 7).select(
        F.col("id").alias("point_id"),
        F.when(F.col("id") % 3 == 0, 33.0)
        .when(F.col("id") % 500 == 1, None)
        .otherwise(hub["a"] + (F.col("id") * 7919 % 400 - 200) / 10.0)
        .alias("latitude"),
        F.when(F.col("id") % 3 == 0, 44.0)
        .otherwise(hub["b"] + (F.col("id") * 104729 % 600 - 300) / 10.0)
        .alias("longitude"),
    )
    return df.persist()


def lloyd(rows, centroids, tol):
    """Plain Python k-means for comparison."""
    moved, n = float("inf"), 0
    while moved > tol:
        n += 1
        groups = [[] for _ in centroids]
        for p in rows:
            km = [chord(p, c) for c in centroids]
            groups[km.index(min(km))].append(p)
        new = [
            (sum(p[0] for p in g) / len(g), sum(p[1] for p in g) / len(g)) if g else c
            for g, c in zip(groups, centroids, strict=True)
        ]
        moved = sum(chord(a, b) for a, b in zip(centroids, new, strict=True))
        old, centroids = centroids, new
    return centroids, [len(g) for g in groups], n, old


INIT = [(10.0, 10.0), (30.0, -60.0), (-10.0, 120.0), (60.0, 60.0), (-40.0, -40.0)]


@pytest.mark.parametrize("cache", ["none", "memory", "table", "tiles"])
def test_fit_equals_plain_python(spark, points, cache):
    rows = [(r[1], r[2]) for r in points.collect() if r[1] is not None]
    want, sizes, n, old = lloyd(rows, INIT, 1.0)
    model = fit(points, init=INIT, cache=cache)
    assert (model.converged, model.iterations) == (True, n)
    assert model.n_unlocated == points.filter("latitude is null").count() > 0
    for got, exp in zip(model.centroids + model.labelling_centroids, want + old, strict=True):
        assert got == pytest.approx(exp, abs=1e-9)
    last = model.history().filter(F.col("iteration") == n).orderBy("cluster_id").collect()
    assert [r["n_points"] for r in last] == sizes
    counts = {r["cluster_id"]: r["count"] for r in model.assignments().groupBy("cluster_id").count().collect()}
    assert counts == {i: c for i, c in enumerate(sizes) if c}
    assert model.assignments().columns == [*points.columns, "cluster_id"]
    assert model.predict().count() == len(rows)


@pytest.mark.parametrize("k", [1, 3, 25])
def test_tiles_label_like_a_full_pass(spark, k):
    df = spark.createDataFrame(some_points(2000), SCHEMA)
    full = fit(df, k, key="point_id", cache="none", max_iter=4, tol_km=-1.0)
    tiled = fit(df, k, key="point_id", cache="tiles", max_iter=4, tol_km=-1.0)
    for a, b in zip(full.records, tiled.records, strict=True):
        assert (a[0], a[1], a[4]) == (b[0], b[1], b[4])
        assert a[2:4] == pytest.approx(b[2:4], abs=1e-9)


@pytest.fixture(scope="module")
def sphere(spark):
    """Tiles of points spread evenly, near the poles too."""
    df = spark.createDataFrame(
        [
            (i, math.degrees(math.asin((i * 0.618034) % 2 - 1)), (i * 137.508) % 360 - 180)
            for i in range(6000)
        ],
        SCHEMA,
    )
    path = new_path(spark, "tiles")
    tiles.write_tiles(df, path)
    return tiles.read_tiles(spark, path, df)


def test_settled_cells_are_right(spark, sphere):
    """Every point of a settled cell has the cell's label, through passes that carry the bounds."""
    cells = tiles.Cells(sphere)
    assert len(cells.cell) <= tiles.MAX_CELLS
    place_of = {r["point_id"]: r["_cell"] for r in sphere.select("point_id", "_cell").collect()}
    start = [(80.0, 0.0), (-75.0, 100.0), (10.0, 179.0), (12.0, -60.0)]
    judged = []
    for move, together in [(0.0, False), (0.01, False), (3.0, False), (3.0, True), (3.5, True), (3.5, False), (40.0, False)]:
        centroids = [(lat - move, lon + (-1) ** i * move) for i, (lat, lon) in enumerate(start)]
        if together:  # two centroids meet, and part again
            centroids[3] = centroids[0]
        before = cells.judged
        cells.settle(centroids)
        judged.append(cells.judged - before)
        settled = cells.placed & ~cells.contested()
        assert 0 < settled.sum() < len(cells.cell)
        label = dict(zip(cells.cell[settled].tolist(), cells.label[settled].tolist(), strict=True))
        found = assign(sphere.select("point_id", "latitude", "longitude"), centroids).select("point_id", "cluster_id")
        for i, cluster in found.collect():
            assert label.get(place_of[i], cluster) == cluster
    assert judged[1] < judged[0] / 2  # a small move leaves most bounds standing


def test_tile_pass_reads_only_border_tiles(sphere):
    cells = tiles.Cells(sphere)
    cells.settle(INIT)
    contested = cells.contested()
    border = tiles.border_points(sphere, cells.tile[contested], cells.cell[contested])
    text = plan(border)
    assert "PartitionFilters: [_tile" in text and "BroadcastHashJoin LeftSemi" in text
    assert border.count() == cells.n[contested].sum() < sphere.count() / 2


def test_settled_tiles_need_no_job(spark):
    """Two far places and their own centroids: nothing is contested, so nothing is read again."""
    df = spark.createDataFrame([(i, 10.0 + 70 * (i % 2), 20.0) for i in range(50)], SCHEMA)
    model = fit(df, init=[(10.0, 20.0), (80.0, 20.0)], cache="tiles")
    assert model.converged and model.centroids == [(10.0, 20.0), (80.0, 20.0)]
    assert [r[4] for r in model.records] == [None, None, 25, 25]


def test_one_small_shuffle_per_iteration(spark, points):
    text = plan(step(points.select("latitude", "longitude"), INIT))
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1
    assert "EvalPython" not in text
    assert "Join" not in text
    assert "partial_avg(latitude" in text


def test_partitioning_does_not_matter(spark, points):
    a = fit(points.coalesce(1), 4, key="point_id")
    b = fit(points.repartition(13), 4, key="point_id")
    assert a.iterations == b.iterations
    for x, y in zip(a.centroids, b.centroids, strict=True):
        assert x == pytest.approx(y, abs=1e-9)


def test_metric_only_changes_the_stop(spark, points):
    a = fit(points, init=INIT, metric="euclidian", max_iter=3, tol_km=-1.0)
    b = fit(points, init=INIT, metric="haversine", max_iter=3, tol_km=-1.0)
    assert [r[:5] for r in a.records] == [r[:5] for r in b.records]
    moved = [(x[5], y[5]) for x, y in zip(a.records, b.records, strict=True) if x[5]]
    assert moved and all(chord_km <= arc_km for chord_km, arc_km in moved)


def test_empty_cluster_keeps_its_centroid(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0), (1, 1.0, 3.0), (2, 40.0, 40.0)], SCHEMA)
    for cache in ("memory", "tiles"):
        model = fit(df, init=[(1.0, 1.0), (1.0, 1.0), (40.0, 40.0)], cache=cache)
        assert model.converged
        sizes = {r["cluster_id"]: r["n_points"] for r in model.history().collect() if r["iteration"] == 1}
        assert sizes == {0: 2, 1: 0, 2: 1}
        assert all(math.isfinite(v) for c in model.centroids for v in c)


@pytest.mark.parametrize("cache", ["memory", "table"])
def test_resumed_fit_equals_the_uninterrupted(spark, points, tmp_path, cache):
    """Unrounded: the same centroids, to the last bit, and one history."""
    path = str(tmp_path / "history")
    one_part = points.coalesce(1)
    whole = fit(one_part, init=INIT, metric="haversine", cache=cache)
    assert whole.iterations > 3
    first = fit(one_part, init=INIT, metric="haversine", max_iter=2, history=path, cache=cache)
    assert (first.iterations, first.converged) == (2, False)
    last = fit(one_part, resume=path, cache=cache)
    assert (last.centroids, last.labelling_centroids) == (whole.centroids, whole.labelling_centroids)
    assert (last.iterations, last.converged, last.n_unlocated) == (whole.iterations, True, whole.n_unlocated)
    assert [r[:6] for r in last.records] == [r[:6] for r in whole.records]
    again = fit(one_part, resume=path, cache=cache)  # nothing left to do
    assert (again.centroids, again.labelling_centroids, again.iterations) == (last.centroids, last.labelling_centroids, last.iterations)


def test_half_written_iterations_do_not_count(spark, points, tmp_path):
    path = tmp_path / "history"
    first = fit(points, init=INIT, max_iter=3, tol_km=-1.0, history=str(path))
    (path / "iteration-00000003" / "_SUCCESS").unlink()
    last = fit(points, resume=str(path), max_iter=3, tol_km=-1.0)
    assert last.iterations == 3 and sorted(r[:2] for r in last.records) == sorted(r[:2] for r in first.records)
    for a, b in zip(last.centroids, first.centroids, strict=True):
        assert a == pytest.approx(b, abs=1e-9)


def test_resume_refuses_another_fit(spark, points, tmp_path):
    path = str(tmp_path / "history")
    with pytest.raises(ValueError, match="no history"):
        fit(points, resume=path)
    fit(points, init=INIT, max_iter=1, history=path)
    for options in ({"k": 3}, {"metric": "haversine"}, {"float32_centroids": True}):
        with pytest.raises(ValueError, match="the fit to resume has"):
            fit(points, resume=path, **options)
    with pytest.raises(ValueError, match="already holds a history"):
        fit(points, init=INIT, history=path)


def test_long_histories_leave_the_driver(spark, points, monkeypatch):
    held = fit(points, init=INIT, max_iter=3, tol_km=-1.0)
    monkeypatch.setattr(history, "MOST_HELD", 12)
    stored = fit(points, init=INIT, max_iter=3, tol_km=-1.0)
    assert stored.log.path and not held.log.path and not stored.log._held
    assert [r[:2] for r in stored.records] == [r[:2] for r in held.records]


def test_grid_equals_single_fits(spark, points):
    models = fit_grid(points, (3, 20, 5), key="point_id")
    assert list(models) == [(k, m) for k in (3, 20, 5) for m in ("euclidean", "haversine")]
    for (k, metric), model in models.items():
        alone = fit(points, k, metric=metric, key="point_id")
        assert (model.iterations, model.converged, model.n_unlocated) == (alone.iterations, True, alone.n_unlocated)
        for a, b in zip(model.records, alone.records, strict=True):
            assert (a[0], a[1], a[4]) == (b[0], b[1], b[4])
            assert a[2:4] == pytest.approx(b[2:4], abs=1e-9)
        assert model.assignments().count() == alone.assignments().count()


def test_grid_pass_is_one_scan_and_one_shuffle(spark, points, tmp_path):
    path = str(tmp_path / "points")
    points.write.parquet(path)
    placed = place(spark.read.parquet(path).select("latitude", "longitude"))
    many = [((i * 53 % 160) - 80.0, (i * 97 % 340) - 170.0) for i in range(20)]
    text = plan(grid_pass(placed, [INIT, many, INIT[:2], INIT[:3]]))
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1
    assert len(re.findall(r"^\(\d+\) Scan", text, re.M)) == 1
    assert text.count("ArrowEvalPython") == 2  # one function; the plan names it twice
    assert "EvalPython" not in plan(grid_pass(placed, [INIT, INIT[:2]]))


def test_grid_takes_as_many_passes_as_its_longest_fit(spark, points, monkeypatch):
    passes = []
    monkeypatch.setattr(grid, "grid_pass", lambda placed, models: passes.append(len(models)) or grid_pass(placed, models))
    models = fit_grid(points, (3, 5), key="point_id", max_iter=6)
    assert len(passes) == max(m.iterations for m in models.values())
    assert passes[0] == 2  # both metrics of a k share their centroids


def test_grid_checks(points):
    for ks, metrics in (((), ["euclidean"]), ((0, 2), ["euclidean"]), ((2,), ["taxicab"])):
        with pytest.raises(ValueError):
            fit_grid(points, ks, metrics)


def test_float32_centroids(spark, points):
    model = fit(points, init=INIT, float32_centroids=True, max_iter=1)
    for pair in model.centroids:
        assert all(struct.unpack("f", struct.pack("f", v))[0] == v for v in pair)


def test_iteration_cap(spark, points):
    model = fit(points, init=INIT, max_iter=1)
    assert (model.iterations, model.converged) == (1, False)


def test_rejected_arguments(spark, points):
    with pytest.raises(ValueError, match="at least 1"):
        fit(points, 0)
    with pytest.raises(ValueError, match="unknown metric"):
        fit(points, 2, metric="taxicab")
    with pytest.raises(ValueError, match="unknown cache"):
        fit(points, 2, cache="ram")
    with pytest.raises(ValueError, match="either k or init"):
        fit(points)
    with pytest.raises(ValueError, match="for k=2"):
        fit(points, 2, init=INIT)
    three = spark.createDataFrame([(0, 1.0, 1.0), (1, 1.0, 1.0), (2, 2.0, 2.0)], SCHEMA)
    with pytest.raises(ValueError, match="only 3 points"):
        fit(three, 5, key="point_id")
    with pytest.raises(ValueError, match="only 2 points"):
        fit(three, 3)


def test_seeds(spark, points):
    located = {(r[1], r[2]) for r in points.collect() if r[1] is not None}
    for key in ("point_id", None):
        drawn = sample_seeds(points, 9, 1, key)
        assert drawn == sample_seeds(points.repartition(5), 9, 1, key)
        assert drawn != sample_seeds(points, 9, 2, key)
        assert set(drawn) <= located and len(drawn) == 9
        assert len(sample_seeds(points, 9, None, key)) == 9
    # Without a key no place is drawn twice, though one holds a third of the rows.
    assert len(set(sample_seeds(points, 40, 1))) == 40
    table = {r["cluster_id"]: (r["latitude"], r["longitude"]) for r in seed_centroids(points, 9).collect()}
    assert [table[i] for i in range(9)] == sample_seeds(points, 9, 1, "point_id")


def test_seeds_from_hardly_more_places_than_wanted(spark):
    df = spark.range(1000).selectExpr("cast(id % 12 as double) as latitude", "0D as longitude")
    for k in (1, 11, 12):
        assert len(set(sample_seeds(df, k))) == k


def test_seeds_by_rows_take_dense_places_more_often(spark, points):
    """A third of the rows are on one spot; equal for any partitioning, a prefix for smaller k."""
    drawn = sample_seeds(points, 60, 1, draw="rows")
    assert drawn == sample_seeds(points.repartition(11), 60, 1, draw="rows")
    assert drawn[:7] == sample_seeds(points, 7, 1, draw="rows")
    assert 10 <= drawn.count((33.0, 44.0)) <= 32
    everything = sorted(sample_seeds(points, points.filter("latitude is not null").count(), 1, draw="rows"))
    assert everything == sorted((r[1], r[2]) for r in points.collect() if r[1] is not None)
    with pytest.raises(ValueError, match="only"):
        sample_seeds(points, 10_000, 1, draw="rows")
    with pytest.raises(ValueError, match="unknown draw"):
        sample_seeds(points, 2, draw="cells")


def test_copies_of_a_place_are_split_up(spark, monkeypatch):
    df = spark.range(500).selectExpr("IF(id < 450, 5D, CAST(id AS DOUBLE) / 10) AS latitude", "1D AS longitude")
    drawn = sample_seeds(df, 100, 3, draw="rows")
    monkeypatch.setattr(sampling, "ROWS_PER_SPLIT", 16)
    assert sample_seeds(df, 100, 3, draw="rows") == drawn


def test_selection_keeps_few_rows(spark):
    """The threshold leaves a few k rows, also where most rows share a hash."""
    rows = spark.range(200_000).select(sampling.hash_of(sampling.seed_order(1, "id")).alias("_hash"), F.col("id").alias("t"))
    for k in (1, 6, 500):
        edge = sampling._threshold(rows, k)
        assert k <= rows.where(F.col("_hash") < edge).count() <= 3 * k + 20
    hot = rows.withColumn("_hash", F.when(F.col("t") % 3 == 0, F.lit((1 << 59) + 12345)).otherwise(F.col("_hash") % (1 << 58) + (1 << 59)))
    edge = sampling._threshold(hot, 9)
    assert 9 <= hot.where(F.col("_hash") < edge).count() <= 8 * 9 + sampling.BINS + 200_000 // 3 + 1
    few = spark.range(3).select((F.col("id") * 1000).alias("_hash"), F.col("id").alias("t"))
    assert [r["t"] for r in sampling.lowest(few, 5, "t")] == [0, 1, 2]
    assert sampling.lowest(few.limit(0), 5, "t") == []


def test_displacement_of_unpaired_clusters(spark):
    schema = "cluster_id int, latitude double, longitude double"
    old = spark.createDataFrame([(0, 0.0, 0.0), (1, 5.0, 5.0)], schema)
    new = spark.createDataFrame([(0, 0.0, 1.0)], schema)
    moves = {r["cluster_id"]: r["displacement_km"] for r in centroid_moves(old, new).collect()}
    assert moves == {0: pytest.approx(chord((0, 0), (0, 1))), 1: 0.0}
    assert displacement(old, new, "haversine").first()[0] == pytest.approx(6371 * math.radians(1))
