import math

import pytest
from pyspark.sql import functions as F

from spheremeans.functions import geo

R = 6371.0
CASES = [
    ((10.0, 20.0), (10.0, 20.0), 0.0, 0.0),
    ((90.0, 0.0), (-90.0, 0.0), 2 * R, math.pi * R),
    ((0.0, 0.0), (0.0, 180.0), 2 * R, math.pi * R),
    ((90.0, 0.0), (90.0, 123.0), 0.0, 0.0),
    ((0.0, 0.0), (0.0, 90.0), R * math.sqrt(2), R * math.pi / 2),
    ((0.0, -180.0), (0.0, 180.0), 0.0, 0.0),
    ((37.5, -122.5), (-37.5, 57.5), 2 * R, math.pi * R),
]


def _both(spark, pairs):
    df = spark.createDataFrame(
        [(*a, *b) for a, b in pairs], "a double, b double, c double, d double"
    )
    return df.select(
        geo.chord_km("a", "b", "c", "d").alias("chord"),
        geo.haversine_km("a", "b", "c", "d").alias("arc"),
    ).collect()


def test_known_distances(spark):
    rows = _both(spark, [(a, b) for a, b, _, _ in CASES])
    for row, (_, _, chord, arc) in zip(rows, CASES, strict=True):
        assert row["chord"] == pytest.approx(chord, abs=1e-6)
        # Near antipodes the haversine loses digits: the root of 1 - a.
        assert row["arc"] == pytest.approx(arc, abs=1e-3)


def test_chord_follows_from_arc(spark):
    pairs = [((i * 7 % 170 - 85.0, i * 31 % 360 - 180.0), (i * 13 % 170 - 85.0, i * 11 % 360 - 180.0))
             for i in range(200)]
    for row in _both(spark, pairs):
        assert row["chord"] == pytest.approx(2 * R * math.sin(row["arc"] / (2 * R)), abs=1e-6)


def test_metric_names(spark):
    df = spark.range(1)
    for name in ("euclidean", "euclidian", "haversine"):
        zero = F.lit(0.0)
        assert df.select(geo.distance_km(name, zero, zero, zero, zero)).first()[0] == 0.0
    with pytest.raises(ValueError, match="unknown metric"):
        geo.distance_km("manhattan", "a", "b", "c", "d")


def test_located(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame(
        [(1.0, 2.0), (None, 2.0), (1.0, None), (nan, 2.0), (1.0, inf), (-inf, 1.0)],
        "latitude double, longitude double",
    )
    got = [r[0] for r in df.select(geo.is_located("latitude", "longitude")).collect()]
    assert got == [True, False, False, False, False, False]
