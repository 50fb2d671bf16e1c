"""Row numbers for a frame of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spheremeans.config import new_path


def number_rows(df: DataFrame, *order: str, name: str = "row_id", path: str | None = None) -> DataFrame:
    """``df`` with numbers from 0 in the order of columns ``order``, nulls first.

    Ranges of the order are sorted apart and stored, each numbered within itself; the
    counts of the ranges, a row apiece, tell where each begins. No task sorts or sees
    more than a range: rows that are equal in ``order`` are split up too, and numbered in an
    order that the stored table keeps. It lies in ``path`` or the shared folder.
    """
    spark, path = df.sparkSession, path or new_path(df.sparkSession, "numbered")
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order, "_tie")
    ranges = dealt.withColumn("_range", F.spark_partition_id())
    inside = Window.partitionBy("_range").orderBy(*order, "_tie")
    # One window group is one range, and is there already sorted by range.
    ranges.withColumn("_at", F.row_number().over(inside)).drop("_tie").write.parquet(path)
    stored = spark.read.schema(f"{df._jdf.schema().toDDL()}, _range int, _at int").parquet(path)
    starts, begin = [], 0
    for r in stored.groupBy("_range").count().orderBy("_range").collect():  # as many rows as there are ranges
        starts.append((r["_range"], begin))
        begin += r["count"]
    offsets = spark.createDataFrame(starts, "_range int, _begin long")
    numbered = stored.join(F.broadcast(offsets), "_range")
    return numbered.select(*(F.col(f"`{c}`") for c in df.columns), (F.col("_begin") + F.col("_at") - 1).alias(name))
