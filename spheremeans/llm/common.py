"""What several operators share: cutting lineage, folds, walking Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spheremeans.config import shared_dir

LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def cut(df: DataFrame) -> DataFrame:
    """The same rows, read from the shared folder: later plans start here.

    Written once by checkpoint(), so a lost executor costs a re-read at most.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def ranked(df: DataFrame, group: list[str], order: list[str], name: str, range_rows: int | None = None) -> DataFrame:
    """``df`` with column ``name``: each row's place, from 0, among the rows of its ``group`` in ``order``.

    Rows are dealt by ranges of (group, order), a range being what one task sorts, and the counts of
    each group in each range tell where its part of a range begins. A row's number in the stored ``df``
    breaks ties, so rows that are equal in everything are split over ranges like others. ``df`` is read
    twice and must be stored; it has no columns _tie and _range. ``range_rows`` sets the number of
    ranges; without it that is Spark's number of shuffle partitions.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    ranges = () if range_rows is None else (-(-df.count() // range_rows) or 1,)
    dealt = tied.repartitionByRange(*ranges, *group, *order, "_tie").withColumn("_range", F.spark_partition_id())
    dealt = cut(dealt)
    inside = Window.partitionBy(*group, "_range").orderBy(*order, "_tie")
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    begins = dealt.groupBy(*group, "_range").agg(F.count("*").alias("_n"))
    begins = begins.select(
        *(F.col(g).alias(f"_of_{g}") for g in group),
        F.col("_range").alias("_of_range"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_begin"),
    )
    numbered = dealt.withColumn("_in", F.row_number().over(inside) - 1)
    same = numbered["_range"] == begins["_of_range"]
    for g in group:
        same = same & numbered[g].eqNullSafe(begins[f"_of_{g}"])
    return numbered.join(begins, same).select(*df.columns, (F.col("_begin") + F.col("_in")).alias(name))


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id's decimal text modulo ``parts``; null for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % parts


def pick(docs: DataFrame, **kinds: str) -> DataFrame:
    """Only the named columns, cast, whatever else ``docs`` carries."""
    return docs.select(*(docs[name].cast(kind).alias(name) for name, kind in kinds.items()))


def carries(*used: str) -> Callable[[Callable[[DataFrame], DataFrame]], Callable[[DataFrame], DataFrame]]:
    """For a stage on ``used`` columns that returns rows of its table: takes any further columns.

    They travel as one struct, so that no name of theirs meets one that the stage uses inside. A
    MAP has no order and no equality in Spark, and is refused.
    """

    def wrap(stage: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        @wraps(stage)
        def run(docs: DataFrame) -> DataFrame:
            maps = [c for c, kind in docs.dtypes if "map<" in kind]
            if maps:
                raise ValueError(f"columns of maps cannot be compared: {maps}")
            own = [c for c in docs.columns if c in used]
            others = [docs[f"`{c}`"] for c in docs.columns if c not in used]
            out = stage(docs.select(*own, F.struct(*others).alias("further")) if others else docs)
            return out.select(*(F.col(c) if c in used else F.col("further").getField(c).alias(c) for c in docs.columns))

        return run

    return wrap


def text_slices(batch: pa.RecordBatch, column: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``most_bytes`` of text each.

    A longer single text is a part of its own. Bounds what a kernel holds.
    """
    if batch.num_rows == 0:
        return
    lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(lengths) - lengths) // most_bytes
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)
