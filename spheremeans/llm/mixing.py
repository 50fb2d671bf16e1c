"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected target / size times. Documents stand in a fixed
order within their source (size, then a hash of the id); the running sum of expected
copies starts at one random offset for each source, and a document is emitted once for
each integer that its step crosses. Ordering by size spreads the copies over short
and long documents, so the words taken stay near the target.

The running sum of a source is not one task's work: documents are dealt by ranges of that
order, each range is numbered apart, and counts over the ranges give where each begins. Rows
that are equal in all of it, such as copies without an id, are dealt by a stored row number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, carries, cut, ranked

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
SEED = "mix"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def unit(text: Column) -> Column:
    """A number in [0, 1) that depends on the text only; the same in SQL."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def source_targets(sized: DataFrame) -> DataFrame:
    """_source, source_size, target: one row for each source of ``sized``.

    Shares by weight that stop at a ceiling, the excess going to the others by weight,
    are min(ceiling, level * weight) for one level. Sorted by ceiling / weight, the
    level follows from running sums over the sources.
    """
    weights = F.array(*(F.lit(w) for w in WEIGHTS))
    per = sized.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    per = per.withColumn("_weight", F.get(weights, (F.row_number().over(by_name) - 1) % len(WEIGHTS)))
    per = per.withColumn("_ceiling", F.col("source_size") * MOST_COPIES)
    everything = Window.partitionBy(F.lit(0))
    up_to = Window.orderBy(F.col("_ceiling") / F.col("_weight"), F.col("_source").asc_nulls_last())
    up_to = up_to.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per = per.withColumns(
        {
            "_wanted": F.sum("source_size").over(everything) * F.lit(SHARE),
            "_full": F.sum("_ceiling").over(up_to),
            "_left": F.sum("_weight").over(everything) - F.sum("_weight").over(up_to),
            "_ratio": F.col("_ceiling") / F.col("_weight"),
        }
    )
    reached = F.when(F.col("_full") + F.col("_ratio") * F.col("_left") <= F.col("_wanted"), F.col("_full"))
    open_weight = F.when(reached.isNotNull(), F.col("_left"))
    per = per.withColumns(
        {
            "_closed": F.coalesce(F.max(reached).over(everything), F.lit(0)),
            "_open": F.coalesce(F.min(open_weight).over(everything), F.sum("_weight").over(everything)),
        }
    )
    level = F.when(F.col("_open") > 0, (F.col("_wanted") - F.col("_closed")) / F.col("_open"))
    share = F.coalesce(level * F.col("_weight"), F.col("_ceiling").cast("double"))
    return per.select(
        "_source",
        "source_size",
        F.least(F.col("_ceiling").cast("double"), share).alias("target"),
    )


def sample_copies(docs: DataFrame, carry: list[str], cell_rows: int | None = None) -> DataFrame:
    """``carry`` columns with size, source_size, target and copies of every document.

    ``carry`` is for keys, not texts: its columns are written and shuffled.

    docs: doc_id, text and source. A null text has size 0, a null source is a source of its
    own, repeated rows are documents of their own, a source without words takes nothing, and
    an empty table gives no rows. Null ids sort by the digest of the empty string.
    """
    sized = docs.select(
        *(F.col(c) for c in carry),
        F.col("source").cast("string").alias("_source"),
        word_count("text").alias("_size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_hash"),
        F.col("doc_id").cast("long").alias("_id"),
    )
    sized = cut(sized)  # narrow rows; words are counted once
    targets = source_targets(sized)

    placed = ranked(sized, ["_source"], ["_size", "_hash", "_id", *(c for c in carry if c != "doc_id")], "_before", cell_rows)
    targets = targets.select(F.col("_source").alias("_s"), "source_size", "target")
    placed = placed.join(targets, placed["_source"].eqNullSafe(targets["_s"]))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = unit(F.concat(F.lit(SEED), F.coalesce(F.col("_source"), F.lit(""))))
    place = F.col("_before") + 1
    crossed = lambda upto: F.floor(upto * rate + offset)
    return placed.select(
        *(F.col(c) for c in carry),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (crossed(place) - crossed(place - 1)).cast("long").alias("copies"),
    )


@carries("doc_id", "text", "source")
def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: ``docs`` with each row as often as it was drawn, possibly never.

    Equal rows, told by 128 bits of hashes, are one row with the sum of their copies; texts are moved once. Nulls, empty
    texts and an empty table are as in ``sample_copies``; further columns stay as they are.
    """
    columns = docs.columns
    # Hashes pass over nulls, so what is null is hashed too: within ``further`` as JSON, which names its fields.
    nulls = F.concat(*(F.when(docs[c].isNull(), "0").otherwise("1") for c in columns))
    inner = [F.to_json(docs["further"])] if "further" in columns else []
    whole = [nulls, *inner, *(docs[c] for c in columns)]
    keyed = docs.withColumns({"_key": F.xxhash64(*whole), "_key_2": F.xxhash64(F.lit(1), *whole)})
    keys = ["doc_id", "_key", "_key_2"]
    drawn = sample_copies(keyed, keys).where("copies > 0")
    drawn = drawn.groupBy(*(F.col(k).alias(f"_of_{k}") for k in keys)).agg(F.sum("copies").alias("_n"))
    rows = keyed.groupBy(*keys).agg(F.first(F.struct(*(F.col(c) for c in columns))).alias("_row"))
    same = rows["doc_id"].eqNullSafe(drawn["_of_doc_id"]) & (rows["_key"] == drawn["_of__key"])
    rows = rows.join(drawn, same & (rows["_key_2"] == drawn["_of__key_2"]))
    rows = rows.select("_row", F.explode(F.expr("sequence(1L, _n)")).alias("_copy"))
    return rows.select(*(F.col("_row").getField(c).alias(c) for c in columns))
