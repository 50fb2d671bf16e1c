import glob

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from spheremeans.operators.clusters import cluster_lists, cluster_points
from spheremeans.plans import job
from spheremeans.sinks import points as sinks
from spheremeans.sources import clusters as saved
from spheremeans.sources.lines import read_pipe_points

PLACE = ["latitude", "longitude"]


@pytest.fixture(scope="module")
def assigned(spark):
    """Eight clusters; one place in one cluster holds a third of the rows."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, 3000, 1, 5).select(
        F.col("id").alias("point_id"),
        F.when(hot, 7).otherwise(F.col("id") % 12).cast("int").alias("cluster_id"),
        F.when(hot, 1.5).otherwise(F.col("id") / 64.0).alias("latitude"),
        F.when(hot, -2.5).otherwise(-F.col("id") / 128.0).alias("longitude"),
    )


def bag(df):
    return sorted(map(tuple, df.select("cluster_id", *PLACE).collect()))


@pytest.mark.parametrize("key", ["point_id", None])
def test_lists_are_whole_and_bounded(assigned, key):
    lists = cluster_lists(assigned, key, chunk_rows=100)
    sizes = [r[0] for r in lists.select(F.size("lat_list")).collect()]
    assert sum(sizes) == 3000
    assert max(sizes) <= 300
    assert bag(cluster_points(lists)) == bag(assigned)
    assert lists.groupBy("cluster_id", "chunk").count().filter("count > 1").count() == 0


@pytest.mark.parametrize("key", ["point_id", None])
def test_small_clusters_are_one_row(assigned, key):
    lists = cluster_lists(assigned, key)
    assert lists.count() == lists.select("cluster_id").distinct().count() == 8


def test_unlabelled_points_are_left_out(spark, assigned):
    lost = assigned.withColumn("cluster_id", F.when(F.col("cluster_id") != 7, F.col("cluster_id")))
    lists = cluster_lists(lost)
    assert lists.filter("cluster_id is null or cluster_id = 7").count() == 0


@pytest.mark.parametrize("form", ["text", "csv"])
def test_list_files_read_back(spark, assigned, tmp_path, form):
    path = str(tmp_path / "out")
    lists = cluster_lists(assigned, "point_id", 100)
    if form == "text":
        sinks.write_cluster_text(lists, path)
        back = saved.read_cluster_text(spark, path)
        assert bag(saved.read_cluster_points(spark, path)) == bag(assigned)
    else:
        sinks.write_cluster_csv(lists, path)
        back = saved.read_cluster_csv(spark, path)
    assert bag(cluster_points(back)) == bag(assigned)


def test_list_formats(spark, tmp_path):
    lists = spark.createDataFrame(
        [(12, 0, [33.6, -1.25], [2.5, 100.0])],
        "cluster_id int, chunk bigint, lat_list array<double>, long_list array<double>",
    ).coalesce(1)
    sinks.write_cluster_text(lists, str(tmp_path / "t"))
    sinks.write_cluster_csv(lists, str(tmp_path / "c"))
    [text] = [open(f).read() for f in glob.glob(str(tmp_path / "t/part-*"))]
    row = Row(closest_centroid=12, lat_list=["33.6", "-1.25"], long_list=["2.5", "100.0"], chunk=0)
    assert text == f"{row!r}\n"
    [csv] = [open(f).read() for f in glob.glob(str(tmp_path / "c/part-*")) if open(f).read()]
    assert csv == (
        "closest_centroid|lat_list|long_list|chunk\n12|['33.6', '-1.25']|['2.5', '100.0']|0\n"
    )


def test_lines_saved_from_text_coordinates(spark, tmp_path):
    (tmp_path / "a").write_text(
        "Row(closest_centroid=3, lat_list=['33.60', '-1'], long_list=['2.50', '1e2'])\n"
        "Row(closest_centroid=11, lat_list=[], long_list=[])\n"
        "not a cluster\n"
    )
    got = saved.read_cluster_text(spark, str(tmp_path / "a")).orderBy("cluster_id").collect()
    assert [tuple(r) for r in got] == [(3, None, [33.6, -1.0], [2.5, 100.0]), (11, None, [], [])]


@pytest.mark.parametrize("layout", ["partitioned", "flat"])
def test_long_form(spark, assigned, tmp_path, layout):
    path = str(tmp_path / "long")
    sinks.write_assignments(assigned, path, layout)
    assert bag(spark.read.parquet(path)) == bag(assigned)
    assert bool(glob.glob(path + "/cluster_id=7")) == (layout == "partitioned")
    with pytest.raises(ValueError, match="unknown layout"):
        sinks.write_assignments(assigned, path, "other")


def test_clean_points(spark, assigned, tmp_path):
    path = str(tmp_path / "clean")
    sinks.write_clean_points(assigned, path)
    back = read_pipe_points(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, assigned.select(*PLACE).collect()))


@pytest.mark.parametrize("sink", ["assignments", "flat", "csv", "text"])
def test_job(spark, assigned, tmp_path, sink):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    sinks.write_clean_points(assigned, source)
    model = job.run(spark, [source, out, "haversine", "4", "--sink", sink, "--chunk-rows", "200"])
    assert model.converged and len(model.centroids) == 4
    if sink in ("assignments", "flat"):
        back = spark.read.parquet(out)
    else:
        read = saved.read_cluster_csv if sink == "csv" else saved.read_cluster_text
        back = cluster_points(read(spark, out))
    assert bag(back) == bag(model.assignments())


def test_job_on_comma_text(spark, tmp_path):
    lines = ["lat,lon,rest"] + [f"{i % 40}.5,{i % 90}.25,x" for i in range(400)]
    (tmp_path / "cars.csv").write_text("\n".join(lines) + "\n")
    argv = [str(tmp_path / "cars.csv"), str(tmp_path / "out"), "--format", "comma", "--sink", "text"]
    model = job.run(spark, argv)
    assert len(model.centroids) == 6
    assert saved.read_cluster_points(spark, argv[1]).count() == 400


@pytest.mark.parametrize("tail", [["euclidean", "0"], ["taxicab", "3"], ["euclidean", "x"]])
def test_job_rejects(spark, tail):
    with pytest.raises(SystemExit):
        job.run(spark, ["in", "out", *tail])
