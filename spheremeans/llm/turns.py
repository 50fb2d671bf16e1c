"""What the operators on conversations share: numbering long sequences, hashing them in order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut


def digest(*parts: Column) -> Column:
    """128 bits of several texts, told apart by their lengths; never null for texts that are not."""
    told = [F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]
    return F.coalesce(F.unhex(F.md5(F.concat(*told))), F.lit(b""))


def number_rows(df: DataFrame, key: str, order: list[str], name: str = "rank") -> DataFrame:
    """``df`` with each row's number, from 1, among the rows of its key in ``order``, nulls first.

    A key may hold any share of the rows: ranges of (key, order) are sorted apart, and a key that
    runs over several ranges is offset by the counts of the earlier ones. Equal rows are numbered in
    any order, which the stored copy keeps. A null key is a key.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    placed = cut(tied.repartitionByRange(key, *order, "_tie").withColumn("_part", F.spark_partition_id()))
    earlier = Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(F.col(key).alias("_k"), F.col("_part").alias("_p")).agg(F.count("*").alias("_n"))
    offsets = offsets.withColumn("_before", F.sum("_n").over(earlier)).where("_before > 0").drop("_n")
    inside = Window.partitionBy("_part", key).orderBy(*order, "_tie")
    ranked = placed.withColumn(name, F.row_number().over(inside).cast("long"))
    ranked = ranked.join(offsets, ranked[key].eqNullSafe(offsets["_k"]) & (ranked["_part"] == offsets["_p"]), "left")
    ranked = ranked.withColumn(name, F.col(name) + F.coalesce("_before", F.lit(0)))
    return ranked.drop("_tie", "_part", "_k", "_p", "_before")


def hash_in_order(pieces: DataFrame, key: str, order: list[str], piece: str, between: str) -> DataFrame:
    """key, sha256: of a key's texts in order with ``between`` between them, in hexadecimal.

    One hash is one sequence of bytes, so a key is one task's stream; of that the task holds a batch.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, running = None, None
        for batch in batches:
            keys, hashes = [], []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if running is None or k != current:
                    if running is not None:
                        keys.append(current)
                        hashes.append(running.hexdigest())
                    current, running = k, hashlib.sha256(text.encode())
                else:
                    running.update((between + text).encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(0).type), pa.array(hashes, pa.string())], names=[key, "sha256"])
            kind = batch.schema.field(0).type
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], kind), pa.array([running.hexdigest()], pa.string())], names=[key, "sha256"])

    dealt = pieces.repartition(key).sortWithinPartitions(key, *order).select(key, piece)
    return dealt.mapInArrow(stream, f"{key} {dict(pieces.dtypes)[key]}, sha256 string")
