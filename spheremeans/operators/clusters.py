"""Clusters as lists of coordinates, and back to points.

A cluster may be far larger than a row can be, so it is cut into chunks of
about ``chunk_rows`` points, each a row of its own: ``cluster_id, chunk,
lat_list, long_list``. A small cluster is one chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


DEFAULT_CHUNK_ROWS = 100_000
PIECES_PER_CHUNK = 16


def _bucket(key: Column, buckets: Column) -> Column:
    """Spread keys evenly whatever their own pattern."""
    leading = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.pmod(F.conv(leading, 16, 10).cast("bigint"), buckets)


def _with_chunks(assigned: DataFrame, chunk_rows: int, sizes: DataFrame) -> DataFrame:
    """``assigned`` with ``_chunks``, the number of chunks of the row's cluster.

    A cluster that ``sizes`` (cluster_id, n_points) lacks is one chunk.
    """
    chunks = sizes.select(
        F.col("cluster_id").alias("_c"), F.ceil(F.col("n_points") / chunk_rows).cast("bigint").alias("_n")
    )
    rows = assigned.join(chunks, assigned["cluster_id"] == chunks["_c"], "left")
    return rows.withColumn("_chunks", F.greatest(F.coalesce("_n", F.lit(1)), F.lit(1))).drop("_c", "_n")


def cluster_lists(
    assigned: DataFrame,
    key: str | None = None,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Parallel latitude and longitude lists per cluster and chunk.

    With a ``key`` points go to chunks by key and are listed in key order. Rows of a key that
    repeats more than a fraction of a chunk, and rows without one, are dealt by key and place.
    Without a ``key`` points are listed by coordinates. Equal points are first counted together and
    one with many copies is cut up, so copies cannot pile up in one chunk.
    """
    if chunk_rows < 1:
        raise ValueError("chunk_rows must be at least 1")
    assigned = assigned.filter(F.col("cluster_id").isNotNull())
    point = [*([F.col(key).alias("key")] if key else []), "latitude", "longitude"]
    copies = assigned.groupBy("cluster_id", *point).agg(F.count(F.lit(1)).alias("copies"))
    if sizes is None:
        sizes = copies.groupBy("cluster_id").agg(F.sum("copies").alias("n_points"))
    # Copies travel in pieces well below a chunk, so that chunks come out even.
    piece_rows = -(-chunk_rows // PIECES_PER_CHUNK)
    cut = F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {piece_rows}"))).alias("piece")
    pieces = _with_chunks(copies, chunk_rows, sizes).select("*", cut)
    names = [c for c in copies.columns if c not in ("cluster_id", "copies")]
    chunk = F.pmod(F.xxhash64(*names, "piece"), F.col("_chunks"))
    if key:
        often = copies.groupBy(F.col("cluster_id").alias("_c"), F.col("key").alias("_k")).agg(F.sum("copies").alias("_often"))
        often = often.where((F.col("_often") > piece_rows) | F.col("_k").isNull())
        pieces = pieces.join(often, (pieces["cluster_id"] == often["_c"]) & pieces["key"].eqNullSafe(often["_k"]), "left")
        chunk = F.when(F.col("_often").isNull(), _bucket(F.col("key"), F.col("_chunks"))).otherwise(chunk)
    n = F.least(F.lit(piece_rows), F.col("copies") - F.col("piece") * piece_rows).cast("int").alias("n")
    pieces = pieces.select("cluster_id", chunk.alias("chunk"), F.struct(*names, n).alias("item"))
    repeated = F.transform(F.sort_array(F.collect_list("item")), lambda i: F.array_repeat(i, i["n"]))
    grouped = pieces.groupBy("cluster_id", "chunk").agg(F.flatten(repeated).alias("items"))
    return grouped.select(
        "cluster_id",
        "chunk",
        F.transform("items", lambda i: i["latitude"]).alias("lat_list"),
        F.transform("items", lambda i: i["longitude"]).alias("long_list"),
    )


def cluster_points(lists: DataFrame) -> DataFrame:
    """Lists back to one row per point, with its position in the list."""
    keep = [c for c in lists.columns if c not in ("lat_list", "long_list")]
    zipped = F.arrays_zip(
        F.col("lat_list").alias("latitude"), F.col("long_list").alias("longitude")
    )
    return lists.select(*keep, F.posexplode(zipped).alias("position", "point")).select(
        *keep, "position", F.col("point.latitude"), F.col("point.longitude")
    )
