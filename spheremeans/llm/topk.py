"""Exact top-k by inner product: buckets of similar length, pruned per query.

Integer vectors are sorted by length into shards, and shards into buckets of similar length.
With a score ``floor`` that a query's k-th best already reaches, a vector p can only enter
if cos(q, p) >= floor / (|q| |p|), and |p| is at most the bucket's greatest length. From that
local threshold each bucket takes one of three ways for each query:

* above 1, no vector of the bucket can enter: the bucket is skipped;
* high: coordinate pruning. On the query's strongest coordinates the threshold leaves an
  interval of values, found in sorted columns; vectors outside any interval go;
* low: length pruning. The bucket is sorted by length, and only its longer part is kept.

What is left is verified by exact integer products. Bounds are loosened by a relative
1e-9, so rounding never prunes a vector that belongs in the answer.

Queries go in blocks of ``query_rows`` and vectors in shards of about ``shard_rows``; a task
holds one of each. First floors come from the shards of the longest vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SHARD_ROWS = 16384
QUERY_ROWS = 8192
BUCKET_ROWS = 1024
LENGTH_STEPS = 256  # at most so many cuts between lengths; crowded lengths are split by hash
COORDINATE_FROM = 0.7  # local cosine threshold from which coordinates are worth looking at
FOCUS = 4
SLACK = 1e-9

RESULT = "query_id long, vec_id long, score long"


def quantised(vector: str | Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component as longs; null if any component is null or not finite."""
    column = F.col(vector) if isinstance(vector, str) else vector
    doubles = column.cast("array<double>")
    finite = F.forall(doubles, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.when(finite, F.transform(doubles, lambda x: F.floor(x * F.lit(float(scale)))))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, -1) if rows else np.zeros((0, 0), dtype=np.int64)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in exact integers: by floating point where every partial sum is exact there."""
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if largest < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if largest < 1 << 63:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class _Bucket:
    """Vectors of similar length, longest first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray):
        self.ids, self.vectors, self.lengths = ids, vectors, lengths
        self._sorted: tuple[np.ndarray, np.ndarray] | None = None

    def columns(self) -> tuple[np.ndarray, np.ndarray]:
        """Per coordinate: unit components in order, and whose they are."""
        if self._sorted is None:
            unit = self.vectors / np.maximum(self.lengths, 1e-300)[:, None]
            order = np.argsort(unit, axis=0)
            self._sorted = np.take_along_axis(unit, order, axis=0), order
        return self._sorted

    def by_coordinate(self, unit_query: np.ndarray, threshold: float) -> np.ndarray:
        """Positions whose coordinates allow cosine >= threshold with the query."""
        values, order = self.columns()
        alive = np.zeros(len(self.ids), dtype=np.int64)
        focus = np.argsort(-np.abs(unit_query))[:FOCUS]
        for f in focus:
            q = unit_query[f]
            middle = q * threshold
            width = np.sqrt(max(0.0, 1 - threshold * threshold) * max(0.0, 1 - q * q)) + SLACK
            low, high = np.searchsorted(values[:, f], [middle - width, middle + width])
            alive[order[low:high, f]] += 1
        return np.flatnonzero(alive == len(focus))


def _better(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: highest score, then smallest id."""
    return np.lexsort((ids, -scores))[:k]


def search(
    query_ids: np.ndarray,
    queries: np.ndarray,
    floors: np.ndarray,
    ids: np.ndarray,
    vectors: np.ndarray,
    k: int,
    bucket_rows: int = BUCKET_ROWS,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the k best (ids, scores) among ``vectors``, leaving its own id out.

    ``floors`` are scores that a query's k-th best is known to reach (lowest long: unknown).
    """
    lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    order = np.lexsort((ids, -lengths))
    ids, vectors, lengths = ids[order], vectors[order], lengths[order]
    query_lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    floors = floors.copy()
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in query_ids]
    unknown = np.iinfo(np.int64).min

    def offer(i: int, found_ids: np.ndarray, scores: np.ndarray) -> None:
        fits = (scores >= floors[i]) & (found_ids != query_ids[i])
        if not fits.any():
            return
        all_ids = np.concatenate([best[i][0], found_ids[fits]])
        all_scores = np.concatenate([best[i][1], scores[fits]])
        top = _better(all_ids, all_scores, k)
        best[i] = all_ids[top], all_scores[top]
        if len(top) == k:
            floors[i] = max(floors[i], best[i][1][-1])

    for begin in range(0, len(ids), bucket_rows):
        part = slice(begin, begin + bucket_rows)
        bucket = _Bucket(ids[part], vectors[part], lengths[part])
        longest = bucket.lengths[0]
        with np.errstate(divide="ignore", invalid="ignore"):
            threshold = np.where(floors == unknown, -np.inf, floors / (query_lengths * longest)) - SLACK
        # A zero length makes the product zero: it enters unless the floor is above zero.
        threshold = np.where(query_lengths * longest > 0, threshold, np.where(floors > 0, 2.0, -np.inf))
        by_coordinate = (threshold >= COORDINATE_FROM) & (threshold <= 1)
        for i in np.flatnonzero(by_coordinate):
            left = bucket.by_coordinate(queries[i] / query_lengths[i], threshold[i])
            if len(left):
                offer(i, bucket.ids[left], _products(queries[i : i + 1], bucket.vectors[left])[0])
        by_length = np.flatnonzero(threshold < COORDINATE_FROM)
        if len(by_length):
            with np.errstate(divide="ignore", invalid="ignore"):
                needed = np.where(threshold[by_length] > 0, threshold[by_length] * longest, 0.0)
            reach = np.searchsorted(-bucket.lengths, -(needed * (1 - SLACK)), side="right")
            scores = _products(queries[by_length], bucket.vectors[: reach.max()])
            for row, i in enumerate(by_length):
                others = np.flatnonzero(bucket.ids[: reach[row]] != query_ids[i])  # the query may have many rows
                own = scores[row, others]
                if len(own) > 4 * k:  # only what could be among the k best, ties included
                    low = np.partition(own, len(own) - k)[len(own) - k]
                    best_of = own >= max(low, floors[i])
                    others, own = others[best_of], own[best_of]
                offer(i, bucket.ids[others], own)
    return best


def _join_block(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    queries, vectors = _matrix(left["_vector"]), _matrix(right["_vector"])
    if not len(queries) or not len(vectors):
        return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
    query_ids = left["_query"].to_numpy()
    floors = left["_floor"].to_numpy()
    found = search(query_ids, queries, floors, right["_id"].to_numpy(), vectors, k)
    sizes = [len(ids) for ids, _ in found]
    return pa.table(
        {
            "query_id": np.repeat(query_ids, sizes),
            "vec_id": np.concatenate([ids for ids, _ in found]),
            "score": np.concatenate([scores for _, scores in found]),
        }
    )


def _run(queries: DataFrame, shards: DataFrame, shard_keys: DataFrame, k: int) -> DataFrame:
    """Every query block with every shard of its dimension."""
    named = lambda df, side, *names: df.select(*(F.col(n).alias(f"{side}{n}") for n in names), "*")
    keys = ["_dim", "_shard", "_block"]
    blocks = queries.select(F.col("_dim").alias("_d"), "_block").distinct()
    sent = named(queries.join(F.broadcast(shard_keys), "_dim"), "q", *keys).drop(*keys)
    dealt = shards.join(F.broadcast(blocks), shards["_dim"] == blocks["_d"])  # queries / query_rows rows
    dealt = named(dealt, "v", *keys).drop(*keys, "_d")
    left = sent.groupBy(*(f"q{n}" for n in keys))
    right = dealt.groupBy(*(f"v{n}" for n in keys))
    return left.cogroup(right).applyInArrow(lambda key, a, b: _join_block(a, b, k), RESULT)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products for each query.

    Both take vec_id and vector (array of long). Rows with a null id, null vector or no
    component take no part. A query meets vectors of its own dimension whose id is not its
    own; all come back if they are fewer than k. Ties go to the smaller id. Repeated query
    ids with one vector are one query; repeated vector rows each count.
    """
    spark = vectors.sparkSession
    usable = lambda df: df.select(F.col("vec_id").cast("long").alias("_id"), F.col("vector").alias("_vector")).where(
        "_id is not null and size(_vector) > 0"
    )
    square = F.aggregate("_vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    base = usable(vectors).withColumns({"_dim": F.size("_vector"), "_square": square})
    base = cut(base)

    counts = {r[0]: r[1] for r in base.groupBy("_dim").count().collect()}  # one row per dimension
    if not counts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    steps = max(1, min(LENGTH_STEPS, sum(counts.values()) // shard_rows))
    at = base.approxQuantile("_square", [i / steps for i in range(1, steps)], 0.001) if steps > 1 else []
    edges = sorted(set(at), reverse=True)
    # Step 0 holds the longest vectors.
    step = F.size(F.filter(F.array(*(F.lit(float(e)) for e in edges)), lambda e: e > F.col("_square"))) if edges else F.lit(0)
    base = base.withColumn("_step", step)
    sizes = base.groupBy("_dim", "_step").count()  # dimensions x steps rows at most
    sizes = sizes.select("_dim", "_step", F.ceil(F.col("count") / shard_rows).cast("int").alias("_parts"))
    shards = base.join(F.broadcast(sizes), ["_dim", "_step"]).withColumn(
        "_shard", F.struct("_step", F.pmod(F.xxhash64("_id", F.lit(3)), F.col("_parts")).cast("int").alias("part"))
    )
    shards = shards.select("_dim", "_shard", "_id", "_vector")
    shard_keys = sizes.select("_dim", F.explode(F.expr("transform(sequence(0, _parts - 1), p -> named_struct('_step', _step, 'part', p))")).alias("_shard"))

    asked = usable(queries).dropDuplicates(["_id"]).withColumn("_dim", F.size("_vector"))
    totals = {r[0]: r[1] for r in asked.groupBy("_dim").count().collect()}
    n_blocks = F.create_map(*(F.lit(x) for d, n in totals.items() for x in (d, -(-n // query_rows)))) if totals else None
    if n_blocks is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    asked = asked.withColumn("_block", F.pmod(F.xxhash64("_id", F.lit(5)), n_blocks[F.col("_dim")]).cast("int"))
    asked = asked.select(F.col("_id").alias("_query"), "_vector", "_dim", "_block")
    unknown = F.lit(-(1 << 63)).cast("long")

    # The longest vectors of each dimension give every query a floor before the whole search.
    longest = sizes.groupBy("_dim").agg(F.min("_step").alias("_first")).select(
        "_dim", F.struct(F.col("_first").alias("_step"), F.lit(0).alias("part")).alias("_shard")
    )
    seeds = _run(
        asked.withColumn("_floor", unknown), shards.join(F.broadcast(longest), ["_dim", "_shard"], "left_semi"), longest, k
    )
    floors = seeds.groupBy("query_id").agg(F.min("score").alias("_low"), F.count("*").alias("_n"))
    floors = cut(floors.select(F.col("query_id").alias("_query"), F.when(F.col("_n") >= k, F.col("_low")).alias("_known")))
    asked = asked.join(floors, "_query", "left").withColumn("_floor", F.coalesce("_known", unknown)).drop("_known")

    found = _run(asked, shards, shard_keys, k)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
