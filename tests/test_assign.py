import io
import math
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.sql import functions as F

from spheremeans.operators import index
from spheremeans.operators.assign import UNROLL_LIMIT, assign, centroid_list, positions, searcher
from spheremeans.operators.index import tree_search

SCHEMA = "point_id bigint, latitude double, longitude double"


def chord(a, b):
    def at(p):
        lat, lon = map(math.radians, p)
        return math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat)

    return 6371.0 * math.dist(at(a), at(b))


def some_points(n):
    return [(i, (i * 37 % 1700) / 10 - 85, (i * 101 % 3600) / 10 - 180) for i in range(n)]


def some_centroids(k):
    return [((i * 53 % 160) - 80 + 0.123, (i * 97 % 340) - 170 + 0.456) for i in range(k)]


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("k", [1, 2, 7, UNROLL_LIMIT, UNROLL_LIMIT + 1, 60])
def test_label_is_the_nearest(spark, k):
    points, centroids = some_points(400), some_centroids(k)
    df = spark.createDataFrame(points, SCHEMA)
    for limit in (0, 1000 if k <= UNROLL_LIMIT else 0):
        for r in assign(df, centroids, distance="km", unroll_limit=limit).collect():
            km = [chord((r["latitude"], r["longitude"]), c) for c in centroids]
            assert r["cluster_id"] == km.index(min(km))
            assert r["km"] == pytest.approx(min(km), abs=1e-6)


@pytest.mark.parametrize("limit", [0, 1000])
def test_ties_go_to_the_lowest_id(spark, limit):
    df = spark.createDataFrame([(0, 0.0, 0.0), (1, 0.0, 50.0)], SCHEMA)
    centroids = [(0.0, 60.0), (0.0, 10.0), (0.0, -10.0), (0.0, 60.0), (0.0, 10.0)]
    got = {r["point_id"]: r["cluster_id"] for r in assign(df, centroids, unroll_limit=limit).collect()}
    assert got == {0: 1, 1: 0}


def test_near_ties_are_decided_by_distance(spark):
    """Centroids metres apart, points between them: dot products cannot tell."""
    centroids = [(10.0 + i * 1e-7, 20.0 - i * 1e-7) for i in range(40)] + [(10.0, 20.0)]
    points = [(i, 10.0 + i * 3.3e-8, 20.0 - i * 2.9e-8) for i in range(200)]
    df = spark.createDataFrame(points, SCHEMA)
    for r in assign(df, centroids, distance="km", unroll_limit=0).collect():
        km = [chord((r["latitude"], r["longitude"]), c) for c in centroids]
        assert r["km"] == pytest.approx(min(km), abs=1e-9)
        assert km[r["cluster_id"]] == pytest.approx(min(km), abs=1e-9)


@pytest.mark.parametrize("limit", [0, 1000])
def test_no_label_without_a_place(spark, limit):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None, 1.0), (1, 1.0, None), (2, nan, 1.0), (3, 1.0, inf), (4, 1.0, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = assign(df, [(0.0, 0.0), (5.0, 5.0)], distance="km", unroll_limit=limit).collect()
    by_id = {r["point_id"]: r for r in got}
    assert all(by_id[i]["cluster_id"] is None for i in range(4))
    assert all(by_id[i]["km"] is None or math.isnan(by_id[i]["km"]) for i in range(4))
    assert by_id[4]["cluster_id"] == 0


def test_other_columns_survive(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], SCHEMA).withColumn("a b", F.lit("x"))
    got = assign(df, [(0.0, 0.0)], label="nearest")
    assert got.columns == ["point_id", "latitude", "longitude", "a b", "nearest"]
    assert got.first()["a b"] == "x"


def test_label_filter_stays_above_the_distances(spark):
    df = spark.createDataFrame(some_points(50), SCHEMA)
    text = plan(assign(df, some_centroids(UNROLL_LIMIT)).filter("cluster_id = 3"))
    assert text.count("SQRT") <= 2 * UNROLL_LIMIT
    assert "EvalPython" not in text


def test_source_is_pruned_and_no_shuffle(spark, tmp_path):
    path = str(tmp_path / "points")
    spark.createDataFrame(some_points(50), SCHEMA).write.parquet(path)
    found = assign(spark.read.parquet(path).filter("latitude > 10"), some_centroids(4))
    text = plan(found.select("cluster_id"))
    assert "ReadSchema: struct<latitude:double,longitude:double>" in text
    assert "GreaterThan(latitude,10.0)" in text
    assert "Exchange" not in text


def test_centroid_checks(spark):
    schema = "cluster_id int, latitude double, longitude double"
    ok = spark.createDataFrame([(1, 1.0, 2.0), (0, 3.0, 4.0)], schema)
    assert centroid_list(ok) == [(3.0, 4.0), (1.0, 2.0)]
    with pytest.raises(ValueError, match="gaps"):
        centroid_list(spark.createDataFrame([(1, 1.0, 2.0)], schema))
    with pytest.raises(ValueError, match="at least one"):
        centroid_list([])
    with pytest.raises(ValueError, match="finite"):
        centroid_list([(1.0, float("nan"))])


def some_positions(n, seed):
    rng = np.random.default_rng(seed)
    return positions(np.column_stack([np.degrees(np.arcsin(rng.uniform(-1, 1, n))), rng.uniform(-180, 180, n)]))


@pytest.mark.parametrize("k", [1, 2, 11, 12, 13, 100, 1000, 5000])
def test_tree_finds_the_nearest(k):
    centres, points = some_positions(k, 1), some_positions(3000, 2)
    points[:500] = centres[np.arange(500) % k]  # on a centroid
    label, distance, measured = tree_search(centres)(points)
    exact = np.sqrt(((points[:, None] - centres) ** 2).sum(axis=2)) if k <= 1000 else None
    if exact is not None:
        assert (label == exact.argmin(axis=1)).all() and np.allclose(distance, exact.min(axis=1), atol=1e-9)
    scan_label, scan_distance = searcher(places_of(centres), index_from=10**9)(points)
    assert np.allclose(distance, scan_distance, atol=1e-6)
    if k >= 1000:
        assert measured <= k * len(points) / 10


def places_of(xyz):
    return np.column_stack([np.degrees(np.arcsin(xyz[:, 2] / 6371.0)), np.degrees(np.arctan2(xyz[:, 1], xyz[:, 0]))])


def test_tree_gives_ties_to_the_lowest_row():
    """Points on the equator between mirrored centroids, and centroids in several leaves at one place."""
    pairs = np.array([(s * lat, lon) for lon in range(-170, 180, 10) for lat in (20.0, 40.0) for s in (-1, 1)])
    centres = positions(pairs)
    rng = np.random.default_rng(3)
    for order in (np.arange(len(centres)), rng.permutation(len(centres))):
        points = positions(np.column_stack([np.zeros(720), np.arange(-180, 180, 0.5)]))
        label, distance, _ = tree_search(centres[order], leaf=2)(points)
        squares = 0.0
        for axis in range(3):
            squares = squares + np.square(points[:, axis, None] - centres[order][:, axis])
        exact = np.sqrt(squares)
        assert (label == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()


def test_tree_far_from_all_centroids_holds_few_pairs(monkeypatch):
    rng = np.random.default_rng(4)
    centres = positions(rng.normal(0, 1, (4000, 2)) + (60, 10))
    points = positions(rng.normal(0, 1, (600, 2)) + (-60, -170))
    want = tree_search(centres)(points)
    monkeypatch.setattr(index, "_MOST_PAIRS", 500)
    got = tree_search(centres)(points)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all() and got[2] == want[2]


def test_all_forms_give_one_answer(spark):
    points, centroids = some_points(500), some_centroids(150)
    rows = [*points, (-1, None, 1.0), (-2, float("nan"), 1.0), (-3, 1.0, float("inf"))]
    df = spark.createDataFrame(rows, SCHEMA)
    scan = assign(df, centroids, distance="km")
    tree = assign(df, centroids, distance="km", index_from=1)
    assert sorted(map(str, scan.collect())) == sorted(map(str, tree.collect()))
