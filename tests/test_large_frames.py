"""Exact sums, row numbers, the ledger of rejected lines, points along a curve and map pyramids."""

import math
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_assign import SCHEMA, plan, some_points
from test_kmeans import INIT

from spheremeans import assign, fit
from spheremeans.functions.exact import LIMB, limb_names, with_limbs
from spheremeans.operators.centroids import cluster_means
from spheremeans.operators.numbering import number_rows
from spheremeans.plans import cleaning
from spheremeans.plans.pyramid import map_pyramid
from spheremeans.sinks.layout import curve_key, points_in_box, write_along_curve
from spheremeans.sources.ledger import REASONS, clean_with_ledger

# exact sums


def odd_degrees(n=4000, seed=1):
    rng = random.Random(seed)
    kinds = [lambda: rng.uniform(-90, 90), lambda: rng.uniform(-1, 1) * 10.0 ** -rng.randrange(12), lambda: 33.3, lambda: -0.1, lambda: 0.0]
    return [(i % 3, rng.choice(kinds)(), rng.uniform(-180, 180)) for i in range(n)]


def test_limbs_join_to_the_number(spark):
    rows = odd_degrees(500)
    df = with_limbs(spark.createDataFrame(rows, "cluster_id int, latitude double, longitude double"), "latitude")
    for r in df.collect():
        whole, *parts = (r[c] for c in limb_names("latitude"))
        joined = Fraction(whole) + sum(Fraction(p, int(LIMB) ** (i + 1)) for i, p in enumerate(parts))
        assert abs(joined - Fraction(r["latitude"])) < Fraction(1, 2**60) and all(abs(p) < LIMB for p in parts)


def test_exact_means_do_not_depend_on_partitions(spark):
    rows = odd_degrees()
    df = spark.createDataFrame(rows, "cluster_id int, latitude double, longitude double")
    answers = set()
    for parts in (1, 7, 64):
        for seed in (1, 2):
            mixed = df.orderBy(F.rand(seed)).repartition(parts)
            answers.add(tuple(sorted(map(tuple, cluster_means(mixed, exact=True).collect()))))
    assert len(answers) == 1
    for cluster, lat, lon, n in answers.pop():
        own = [r for r in rows if r[0] == cluster]
        assert n == len(own)
        assert lat == pytest.approx(math.fsum(r[1] for r in own) / n, rel=1e-15, abs=1e-17)
        assert lon == pytest.approx(math.fsum(r[2] for r in own) / n, rel=1e-15)


def test_exact_means_take_odd_numbers(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(None, None, 1.0), (None, nan, inf), (0, 1e300, -1e300), (0, 1e6, -1e6), (1, 5e-324, -0.0)]
    df = spark.createDataFrame(rows, "cluster_id int, latitude double, longitude double")
    got = {r["cluster_id"]: tuple(r)[1:] for r in cluster_means(df, exact=True).collect()}
    assert got[0] == (1e6, -1e6, 2) and got[1] == (0.0, 0.0, 1) and got[None][2] == 2


def test_exact_fits_are_equal_to_the_last_bit(spark):
    """Any partitioning, tiles, and a fit that was stopped and resumed."""
    df = spark.createDataFrame(some_points(3000), SCHEMA).repartition(3)
    options = {"init": INIT, "exact": True, "tol_km": -1.0, "max_iter": 4}
    want = fit(df.coalesce(1), cache="none", **options)
    for other in (fit(df.repartition(13), **options), fit(df, cache="tiles", **options)):
        assert [r[:5] for r in other.records] == [r[:5] for r in want.records]
        assert other.centroids == want.centroids


# row numbers


def test_numbers_follow_the_order(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 5.0, 7.5, *range(20)]), rng.choice([1.0, 2.0, None]), f"r{i}") for i in range(3000)]
    rows += [(5.0, 1.0, "hot")] * 2000
    df = spark.createDataFrame([(None if a is None else float(a), b, c) for a, b, c in rows], "a double, b double, `odd name` string")
    got = number_rows(df.repartition(9), "a", "b", name="n")
    assert got.columns == ["a", "b", "odd name", "n"]
    found = got.orderBy("n").collect()
    assert [r["n"] for r in found] == list(range(5000))
    key = lambda r: tuple((v is not None, v or 0.0) for v in r)
    assert [key(r[:2]) for r in found] == sorted(key(r[:2]) for r in rows)
    assert sorted(r["odd name"] for r in found) == sorted(r[2] for r in rows)
    assert number_rows(df.limit(0), "a").count() == 0


def test_numbering_sorts_no_partition_alone(spark):
    got = number_rows(spark.range(10_000).select((F.col("id") % 7).alias("a")), "a")
    text = plan(got)
    assert "Window" not in text and "SinglePartition" not in text
    assert got.agg(F.countDistinct("row_id"), F.max("row_id")).first()[:] == (10_000, 9_999)


# ledger

LINES = {
    "space": ["latitude longitude url", "1.5  2.5 u", "1.5 2.5", "x 2 u", " 1 2 u", "0 1 u", "1 2 3 4"],
    "device": [",".join(["d", "n m", "id", *"1" * 9, lat, lon]) for lat, lon in (("1.5", "2"), ("0.0", "2"), ("bad", "2"), ("", "2"), ("3", "12.5d"))],
    "tab": ["lat\tlon", "1\t2\t3", "0\t2", "x\t2", "-0.5\t3", "7"],
    "comma": ["lat,lon", "1.5,2.5,r", "40,2.5", "1.5,2", "12.5abc,3.5", "1.5", "-0.0,0.0"],
}
PIPELINES = {
    "space": cleaning.clean_place_lines, "device": cleaning.clean_device_lines, "tab": cleaning.clean_tab_lines, "comma": cleaning.clean_comma_lines,
}


@pytest.mark.parametrize("layout", sorted(LINES))
@pytest.mark.parametrize("zero", [None, "truncate"])
def test_every_line_is_accounted_for(spark, tmp_path, layout, zero):
    if layout == "comma" and zero:
        pytest.skip("comma lines have no filter of zeros")
    folder = tmp_path / "lines"
    folder.mkdir()
    for name, lines in (("a", LINES[layout]), ("b", LINES[layout][:3]), ("c", LINES[layout][:1])):
        (folder / name).write_text("\n".join(lines) + "\n")
    cleaned = clean_with_ledger(spark, str(folder), layout, zero)
    want = PIPELINES[layout](spark, str(folder), **({"zero_filter": zero} if zero else {}))
    assert sorted(map(str, cleaned.points.collect())) == sorted(map(str, want.collect()))
    ledger = cleaned.ledger().collect()
    by_reason = {}
    for r in ledger:
        assert r["file"].rsplit("/", 1)[1] in "abc" and r["reason"] in REASONS and r["example"] in LINES[layout]
        by_reason[r["reason"]] = by_reason.get(r["reason"], 0) + r["n_lines"]
    assert cleaned.totals == {**by_reason, None: cleaned.points.count()}
    skipped = 3 if layout in ("space", "tab") else 0
    assert sum(cleaned.totals.values()) == len(LINES[layout]) + 4 - skipped


def test_ledger_reads_only_what_it_needs(spark, tmp_path):
    (tmp_path / "x").write_text("\n".join(LINES["comma"]))
    cleaned = clean_with_ledger(spark, str(tmp_path / "x"), "comma")
    for frame, rejected in ((cleaned.ledger(), "true"), (cleaned.points, "false")):
        assert "PartitionFilters: [isnotnull(rejected" in plan(frame)
        assert all(f"rejected={rejected}" in f for f in frame.inputFiles() if "rejected=" in f) or rejected
    with pytest.raises(ValueError, match="unknown layout"):
        clean_with_ledger(spark, str(tmp_path / "x"), "json")


# points along a curve


def test_curve_keys_take_digits_by_turns(spark):
    rows = [(0, -90.0, -180.0), (1, 90.0, 180.0), (2, 0.0, -180.0), (3, -90.0, 0.0), (4, None, 1.0), (5, float("nan"), 1.0), (6, 1e300, -1e300)]
    got = {r[0]: r[1] for r in spark.createDataFrame(rows, SCHEMA).select("point_id", curve_key()).collect()}
    assert got == {0: 0, 1: 2**32 - 1, 2: 2**31, 3: 2**30, 4: None, 5: None, 6: 0xAAAAAAAA}


def rows_scanned(df):
    """Rows that the scan handed on, after row groups were skipped."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "Adaptive" in node.nodeName():
            node = node.executedPlan()
        if "Scan" in node.nodeName():
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return sum(found)


def test_box_reads_skip_row_groups(spark, tmp_path):
    df = spark.range(0, 200_000, 1, 8).select(
        F.col("id").alias("point_id"),
        ((F.col("id") * 7919) % 180_000 / 1000.0 - 90).alias("latitude"),
        ((F.col("id") * 104_729) % 360_000 / 1000.0 - 180).alias("longitude"),
    )
    along, plain = str(tmp_path / "along"), str(tmp_path / "plain")
    write_along_curve(df, along, row_group_bytes=1 << 16)
    df.write.option("parquet.block.size", 1 << 16).parquet(plain)
    for box in ((10.0, 14.0, 20.0, 26.0), (-60.0, -55.0, 175.0, -178.0)):
        got, want = points_in_box(spark, along, *box), points_in_box(spark, plain, *box)
        assert sorted(got.collect()) == sorted(want.collect()) and got.count() > 10
        assert rows_scanned(points_in_box(spark, along, *box)) < rows_scanned(points_in_box(spark, plain, *box)) / 4


def test_stored_points_keep_their_columns(spark, tmp_path):
    rows = [(1, None, 2.0), (2, 5.0, 5.0), (3, 5.0, 5.0)]
    path = str(tmp_path / "p")
    write_along_curve(spark.createDataFrame(rows, SCHEMA), path)
    stored = spark.read.parquet(path)
    assert stored.columns == ["point_id", "latitude", "longitude"] and stored.count() == 3
    assert sorted(r[0] for r in points_in_box(spark, path, 5.0, 5.0, 5.0, 5.0).collect()) == [2, 3]


# map pyramid


def test_levels_add_up(spark):
    df = assign(spark.createDataFrame([*some_points(2000), (-1, None, 1.0), (-2, 95.0, 400.0)], SCHEMA), INIT)
    found = map_pyramid(df, 5).toPandas()
    labelled = df.where("cluster_id is not null").count()
    assert (found.groupby("zoom")["n_points"].sum() == labelled).all() and len(found.zoom.unique()) == 6
    assert (found["cell_row"] < 2 ** found["zoom"]).all() and (found[["cell_row", "cell_column"]] >= 0).all().all()
    assert np.allclose(found.groupby(["zoom", "cell_row", "cell_column"])["share"].sum(), 1.0)
    top = found[found.zoom == 0].set_index("cluster_id")["n_points"].to_dict()
    assert top == {r[0]: r[1] for r in df.where("cluster_id is not null").groupBy("cluster_id").count().collect()}
    assert len(found[found.zoom == 5]) <= 4**5 * len(INIT)
    with pytest.raises(ValueError, match="max_zoom"):
        map_pyramid(df, 13)


def test_pyramid_scans_once(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame(some_points(100), SCHEMA).write.parquet(path)
    text = plan(map_pyramid(assign(spark.read.parquet(path), INIT), 4))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 1
    assert "partial_count(1)" in text and "SinglePartition" not in text
