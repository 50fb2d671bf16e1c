"""The registered queries. Each reads whole tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spheremeans.catalog.fixtures import point_view, written_lines
from spheremeans.config import new_path
from spheremeans.functions import geo, text
from spheremeans.operators import centroids as cent
from spheremeans.operators.assign import assign
from spheremeans.operators.clusters import cluster_lists, cluster_points
from spheremeans.operators.filters import decimal_shaped, has_fields, nonzero
from spheremeans.operators.numbering import number_rows
from spheremeans.plans import cleaning
from spheremeans.plans.grid import fit_grid
from spheremeans.plans.kmeans import CENTROID_SCHEMA, Model, fit
from spheremeans.plans.pyramid import map_pyramid
from spheremeans.sinks import points as sinks
from spheremeans.sinks.layout import points_in_box, write_along_curve
from spheremeans.sources import clusters as saved
from spheremeans.sources import lines as scans
from spheremeans.sources.ledger import clean_with_ledger

Query = Callable[[SparkSession, str], DataFrame]

K, SEED, KEY, CHUNK = 6, 1, "point_id", 100

# Pairs that mirror each other at the equator, and copies.
TIED = [(s * lat, lon) for lon in range(-160, 180, 40) for lat in (20.0, 40.0) for s in (1, -1)] + [(20.0, 0.0)] * 3


def _r(column: Column | str, name: str | None = None) -> Column:
    return F.round(column, 6).alias(name or str(column))


PLACE = ("latitude", "longitude")


def _rounded(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, *[_r(c) for c in PLACE])


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return point_view(spark, sf_dir, "customer_points")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return point_view(spark, sf_dir, "event_points")


def _seeded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[tuple[float, float]]]:
    points = _events(spark, sf_dir)
    return points, cent.sample_seeds(points, K, SEED, KEY)


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(*_seeded(spark, sf_dir))


def _fit(spark: SparkSession, sf_dir: str, view: str = "event_points", **options) -> Model:
    return fit(point_view(spark, sf_dir, view), **options)


def _to_hub(distance: Callable[..., Column], name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        km = distance("latitude", "longitude", F.lit(48.0), F.lit(-157.0))
        return _events(spark, sf_dir).select(KEY, _r(km, name))

    return query


def _labels(unroll_limit: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        points, seeds = _seeded(spark, sf_dir)
        found = assign(points, seeds, distance="distance_km", unroll_limit=unroll_limit)
        return found.select(KEY, "cluster_id", _r("distance_km"))

    return query


def cluster_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = cent.cluster_means(_assigned(spark, sf_dir))
    return _rounded(means, "cluster_id", "n_points").orderBy("cluster_id")


def lineitem_cluster_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = point_view(spark, sf_dir, "region_seeds")
    means = cent.cluster_means(assign(point_view(spark, sf_dir, "lineitem_points"), seeds))
    return _rounded(means, "cluster_id", "n_points")


def seed_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(cent.seed_centroids(_events(spark, sf_dir), K, SEED), "cluster_id")


def _drawn(draw: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Without a key; one place holds a third of the rows."""
        points = point_view(spark, sf_dir, "lineitem_points")
        return _rounded(cent.seed_centroids(points, 40, SEED, None, draw), "cluster_id")

    return query


def nearest_centroid_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's place is a centroid; a tree finds the nearest."""
    centroids = _customers(spark, sf_dir).orderBy(KEY).select(*PLACE).collect()
    found = assign(_events(spark, sf_dir), centroids, distance="distance_km", index_from=1)
    return found.select(KEY, "cluster_id", _r("distance_km"))


def cluster_lists_keyless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of a table without a key, one place holding a third of it, read back."""
    points = point_view(spark, sf_dir, "lineitem_points")
    lists = cluster_lists(assign(points, point_view(spark, sf_dir, "region_seeds")), chunk_rows=CHUNK)
    return _rounded(cluster_points(lists), "cluster_id")


def cluster_lists_repeated_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists by a key of three values, each far more frequent than a chunk is long, read back."""
    points = _assigned(spark, sf_dir).withColumn(KEY, F.col(KEY) % 3)
    return _rounded(cluster_points(cluster_lists(points, KEY, CHUNK)), "cluster_id")


def cluster_lists_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = cluster_lists(_assigned(spark, sf_dir), KEY, CHUNK)

    def joined(name: str) -> Column:
        return F.array_join(F.transform(name, lambda v: F.format_string("%.6f", v)), ",").alias(name)

    return lists.select(
        "cluster_id",
        "chunk",
        F.size("lat_list").cast("bigint").alias("n_points"),
        joined("lat_list"),
        joined("long_list"),
    ).orderBy("cluster_id", "chunk")


def cluster_points_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = cluster_points(cluster_lists(_assigned(spark, sf_dir), KEY, CHUNK))
    return _rounded(points, "cluster_id", "chunk", F.col("position").cast("bigint").alias("position"))


def cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cent.cluster_sizes(_assigned(spark, sf_dir)).orderBy("cluster_id")


def centroid_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = cent.cluster_means(
        assign(point_view(spark, sf_dir, "lineitem_points"), point_view(spark, sf_dir, "nation_seeds"))
    )
    return _rounded(cent.number_centroids(means.drop("cluster_id"), *PLACE), "cluster_id", "n_points")


def _before_and_after(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Seeds and the means they lead to; the seeds are drawn once."""
    points, seeds = _seeded(spark, sf_dir)
    rows = [(i, lat, lon) for i, (lat, lon) in enumerate(seeds)]
    return spark.createDataFrame(rows, CENTROID_SCHEMA), cent.cluster_means(assign(points, seeds))


def _displacement(metric: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        old, new = _before_and_after(spark, sf_dir)
        return cent.displacement(old, new, metric).select(_r("displacement_km"))

    return query


def centroid_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    moves = cent.centroid_moves(*_before_and_after(spark, sf_dir))
    return moves.select("cluster_id", *[_r(c) for c in moves.columns if c != "cluster_id"])


def _final(model: Model) -> DataFrame:
    last = model.history().filter(F.col("iteration") == model.iterations)
    return _rounded(last, "iteration", "cluster_id", "n_points")


def kmeans_3_iterations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final(_fit(spark, sf_dir, k=K, key=KEY, tol_km=-1.0, max_iter=3))


def kmeans_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final(_fit(spark, sf_dir, k=K, key=KEY))


def kmeans_converged_haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final(_fit(spark, sf_dir, k=5, key=KEY, metric="haversine", tol_km=5.0, cache="none"))


def kmeans_converged_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final(_fit(spark, sf_dir, "customer_points", k=K, key=KEY, cache="table"))


def kmeans_lineitem_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = point_view(spark, sf_dir, "region_seeds")
    return _final(_fit(spark, sf_dir, "lineitem_points", init=seeds))


def kmeans_lineitem_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = point_view(spark, sf_dir, "nation_seeds")
    return _final(_fit(spark, sf_dir, "lineitem_points", init=seeds))


def kmeans_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = _fit(spark, sf_dir, k=K, key=KEY).history()
    return _rounded(history, "iteration", "cluster_id", "n_points", _r("displacement_km"))


def kmeans_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_fit(spark, sf_dir, k=K, key=KEY).assignments(), KEY, "cluster_id")


def kmeans_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final(_fit(spark, sf_dir, k=K, key=KEY, cache="tiles"))


def kmeans_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stopped after two passes, then taken up again by its folder: the whole history."""
    path = new_path(spark, "history")
    _fit(spark, sf_dir, k=K, key=KEY, max_iter=2, history=path)
    history = _fit(spark, sf_dir, resume=path).history()
    return _rounded(history, "iteration", "cluster_id", "n_points", _r("displacement_km"))


def kmeans_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The factors of the published runtime analysis, k and metric, in shared passes."""
    models = fit_grid(_events(spark, sf_dir), (2, 5, 6, 20), key=KEY)
    finals = [
        _final(model).withColumns({"k": F.lit(k), "metric": F.lit(metric)}) for (k, metric), model in models.items()
    ]
    out = finals[0]
    for more in finals[1:]:
        out = out.unionByName(more)
    return out


def float32_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final(_fit(spark, sf_dir, k=K, key=KEY, tol_km=-1.0, max_iter=2, float32_centroids=True))


def cluster_mean_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not rounded: sums are exact, so there is one answer whatever the partitions."""
    points = point_view(spark, sf_dir, "lineitem_points").repartition(7)
    means = cent.cluster_means(assign(points, point_view(spark, sf_dir, "region_seeds")), exact=True)
    return means.select("cluster_id", "n_points", *PLACE)


def kmeans_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not rounded either, after all iterations."""
    model = fit(_events(spark, sf_dir).repartition(5), K, key=KEY, exact=True)
    last = model.history().filter(F.col("iteration") == model.iterations)
    return last.select("iteration", "cluster_id", "n_points", *PLACE)


def numbered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = point_view(spark, sf_dir, "lineitem_points")
    return _rounded(number_rows(points, *PLACE), "row_id")


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept and rejected lines of each layout by reason, from one scan apiece."""
    out = None
    for layout in ("space", "device", "tab", "comma"):
        cleaned = clean_with_ledger(spark, written_lines(spark, sf_dir, layout), layout, skip_first=layout != "device")
        counts = cleaned.ledger().groupBy("reason").agg(F.sum("n_lines").alias("n_lines"))
        counts = counts.unionByName(cleaned.points.agg(F.lit("kept").alias("reason"), F.count(F.lit(1)).alias("n_lines")))
        counts = counts.select(F.lit(layout).alias("layout"), "reason", "n_lines")
        out = counts if out is None else out.unionByName(counts)
    return out


def box_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box read from points stored along a curve."""
    path = new_path(spark, "curve")
    write_along_curve(_events(spark, sf_dir), path)
    return _rounded(points_in_box(spark, path, -20.0, 30.0, 100.0, -150.0), KEY)


def map_pyramid_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = map_pyramid(_assigned(spark, sf_dir), 6)
    return _rounded(found, "zoom", "cell_row", "cell_column", "cluster_id", "n_points", _r("share"))


def kmeans_many_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final(_fit(spark, sf_dir, "customer_points", k=100, key=KEY, tol_km=-1.0, max_iter=2))


def kmeans_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_fit(spark, sf_dir, k=K, key=KEY).predict(), KEY, "cluster_id")


def kmeans_unlocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth point lacks a coordinate; they are counted and get no label."""
    points = _events(spark, sf_dir).withColumn("latitude", F.when(F.col(KEY) % 10 != 0, F.col("latitude")))
    model = fit(points, init=point_view(spark, sf_dir, "region_seeds"), tol_km=-1.0, max_iter=2)
    return _final(model).withColumn("n_unlocated", F.lit(model.n_unlocated).cast("bigint"))


def kmeans_empty_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A centroid that is nobody's nearest stays where it is."""
    seeds = [(r.latitude, r.longitude) for r in point_view(spark, sf_dir, "region_seeds").orderBy("cluster_id").collect()]
    return _final(_fit(spark, sf_dir, init=[*seeds, (89.0, 0.0)], tol_km=-1.0, max_iter=2))


def nearest_centroid_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points on the equator between mirrored and repeated centroids: the lowest id wins."""
    points = _events(spark, sf_dir).withColumn("latitude", F.lit(0.0))
    found = assign(points, TIED, distance="distance_km", unroll_limit=0)
    both = assign(found.withColumnRenamed("cluster_id", "by_array"), TIED)
    return both.select(KEY, "by_array", "cluster_id", _r("distance_km"))


def scan_pipe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(scans.read_pipe_points(spark, written_lines(spark, sf_dir, "pipe")))


def scan_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.read_space_fields(spark, written_lines(spark, sf_dir, "space"))


def scan_multi_delim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.read_device_fields(spark, written_lines(spark, sf_dir, "device"))


def scan_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.read_tab_fields(spark, written_lines(spark, sf_dir, "tab"))


def scan_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.read_comma_fields(spark, written_lines(spark, sf_dir, "comma"), skip_first=True)


def line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = scans.read_lines(spark, written_lines(spark, sf_dir, "tab"), skip_first=True)
    return lines.agg(F.count(F.lit(1)).alias("n_lines"))


def arity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = scans.read_lines(spark, written_lines(spark, sf_dir, "space"), skip_first=True)
    return lines.filter(has_fields(text.fields("value", text.SPACES, 3), 3))


def scan_first_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.read_lines(spark, written_lines(spark, sf_dir, "space"), skip_first=True)


def decimal_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scans.read_comma_fields(spark, written_lines(spark, sf_dir, "comma"))
    return found.filter(decimal_shaped("latitude") & decimal_shaped("longitude"))


def _zero_filter(mode: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = scans.read_device_fields(spark, written_lines(spark, sf_dir, "device"))
        return found.filter(nonzero("latitude", mode)).select("deviceId", "latitude")

    return query


def device_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = cleaning.device_records(spark, written_lines(spark, sf_dir, "device"))
    return _rounded(records, "date", "deviceId", "manufacturer", "model")


def _cleaned(pipeline: Callable[..., DataFrame], layout: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(pipeline(spark, written_lines(spark, sf_dir, layout)))

    return query


def clean_points_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "clean-points")
    sinks.write_clean_points(_events(spark, sf_dir), path)
    return _rounded(scans.read_pipe_points(spark, path))


def cluster_long_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "assignments")
    sinks.write_assignments(_assigned(spark, sf_dir), path)
    return _rounded(spark.read.parquet(path), KEY, "cluster_id")


def _list_roundtrip(write: Callable[..., None], read: Callable[..., DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = new_path(spark, "clusters")
        write(cluster_lists(_assigned(spark, sf_dir), KEY, CHUNK), path)
        return _rounded(cluster_points(read(spark, path)), "cluster_id", "chunk")

    return query


QUERIES: dict[str, Query] = {
    "chord_distance": _to_hub(geo.chord_km, "chord_km"),
    "haversine_distance": _to_hub(geo.haversine_km, "haversine_km"),
    "seed_sample": seed_sample,
    "seed_rows": _drawn("rows"),
    "seed_places": _drawn("places"),
    "nearest_centroid": _labels(unroll_limit=K),
    "nearest_centroid_array": _labels(unroll_limit=0),
    "nearest_centroid_indexed": nearest_centroid_indexed,
    "cluster_mean": cluster_mean,
    "lineitem_cluster_mean": lineitem_cluster_mean,
    "cluster_lists": cluster_lists_query,
    "cluster_lists_keyless": cluster_lists_keyless,
    "cluster_lists_repeated_key": cluster_lists_repeated_key,
    "cluster_points_exploded": cluster_points_exploded,
    "cluster_sizes": cluster_sizes,
    "centroid_ids": centroid_ids,
    "centroid_pairs": centroid_pairs,
    "centroid_displacement_chord": _displacement("euclidean"),
    "centroid_displacement_haversine": _displacement("haversine"),
    "kmeans_3_iterations": kmeans_3_iterations,
    "kmeans_converged": kmeans_converged,
    "kmeans_converged_haversine": kmeans_converged_haversine,
    "kmeans_converged_customer": kmeans_converged_customer,
    "kmeans_lineitem_regions": kmeans_lineitem_regions,
    "kmeans_lineitem_nations": kmeans_lineitem_nations,
    "kmeans_tiles": kmeans_tiles,
    "kmeans_resumed": kmeans_resumed,
    "kmeans_grid": kmeans_grid,
    "kmeans_exact": kmeans_exact,
    "cluster_mean_exact": cluster_mean_exact,
    "numbered_rows": numbered_rows,
    "rejected_lines": rejected_lines,
    "box_points": box_points,
    "map_pyramid": map_pyramid_query,
    "float32_centroids": float32_centroids,
    "kmeans_many_centroids": kmeans_many_centroids,
    "kmeans_predict": kmeans_predict,
    "kmeans_unlocated": kmeans_unlocated,
    "kmeans_empty_cluster": kmeans_empty_cluster,
    "nearest_centroid_ties": nearest_centroid_ties,
    "kmeans_history": kmeans_history,
    "kmeans_assignments": kmeans_assignments,
    "scan_pipe": scan_pipe,
    "scan_space": scan_space,
    "scan_multi_delim": scan_multi_delim,
    "scan_tab": scan_tab,
    "scan_comma": scan_comma,
    "line_count": line_count,
    "arity_filter": arity_filter,
    "scan_first_line": scan_first_line,
    "decimal_filter": decimal_filter,
    "zero_lat_exact": _zero_filter("exact"),
    "zero_lat_truncate": _zero_filter("truncate"),
    "device_fields": device_fields,
    "clean_place_lines": _cleaned(cleaning.clean_place_lines, "space"),
    "clean_device_lines": _cleaned(cleaning.clean_device_lines, "device"),
    "clean_tab_lines": _cleaned(cleaning.clean_tab_lines, "tab"),
    "clean_comma_lines": _cleaned(cleaning.clean_comma_lines, "comma"),
    "clean_points_roundtrip": clean_points_roundtrip,
    "cluster_long_roundtrip": cluster_long_roundtrip,
    "cluster_text_roundtrip": _list_roundtrip(sinks.write_cluster_text, saved.read_cluster_text),
    "cluster_csv_roundtrip": _list_roundtrip(sinks.write_cluster_csv, saved.read_cluster_csv),
}
