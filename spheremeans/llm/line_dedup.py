"""Dropping lines that repeat across documents, with DataFrame functions only.

Texts are split into lines, lines are normalised to keys and keys hashed to 128 bits. The
documents of each hash are counted in two steps, first distinct (hash, document) pairs, which
spreads a line that everybody holds, then one row for each hash from partial counts. Only
(hash, document, place) travels to be judged; texts move once, to meet the places that their
rows lose, and what lies between those places is joined again in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER

# Fixed value: the white space that is stripped from both ends of a line.
STRIPPED = "\x20\x09\x0a\x0b\x0c\x0d"

LEAST_CHARS = 10
LEAST_DOCS = 2


def _lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else; ``lower`` is the faster way where all is ASCII."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _digest(text: Column | str) -> Column:
    """Never null, or the optimiser would filter nulls and hash everything twice for it."""
    return F.coalesce(F.unhex(F.md5(text)), F.lit(b""))


def drop_repeated_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """doc_id, text (the lines that stay), n_lines (before) and n_dropped of each row of ``docs``.

    A line's key is the line without white space at its ends, A-Z lowered. A key of at least
    ``least_chars`` code points found in at least ``least_docs`` documents keeps its lines in
    the document of the smallest id only; shorter keys stay everywhere.

    docs: doc_id and text; further columns, whatever their names, take no part. A null or empty
    text is one empty line. Rows that repeat an id are one document for the count and keep
    the same lines; so are all rows without an id, which come after every id. An
    empty table gives no rows.
    """
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    ).withColumn("_row", _digest("text"))
    stripped = F.transform(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(STRIPPED)))
    lines = rows.select("doc_id", "_row", F.posexplode(stripped).alias("_at", "_key"))
    lines = lines.where(F.length("_key") >= least_chars)
    lines = lines.select("doc_id", "_row", "_at", _digest(_lowered(F.col("_key"))).alias("_hash"))

    holders = lines.select("_hash", "doc_id").distinct()
    keys = holders.groupBy("_hash").agg(F.count("*").alias("_docs"), F.min("doc_id").alias("_first"))
    # The name is new to the planner, so the keys get an exchange of their own. Between two such
    # exchanges adaptive execution splits the task of a line that everybody holds.
    keys = keys.where(F.col("_docs") >= least_docs).select(F.concat("_hash", F.lit(b"")).alias("_repeated"), "_first")
    lost = lines.join(keys, F.col("_hash") == F.col("_repeated")).where(~F.col("doc_id").eqNullSafe(F.col("_first")))
    lost = lost.groupBy(F.col("doc_id").alias("_d"), F.col("_row").alias("_r")).agg(
        F.sort_array(F.collect_set("_at")).alias("_lost")
    )

    found = rows.join(lost, rows["doc_id"].eqNullSafe(lost["_d"]) & (rows["_row"] == lost["_r"]), "left")
    found = found.select("doc_id", "text", "_lost", F.split("text", "\n").alias("_lines"))
    between = F.expr(
        "transform(sequence(0, size(_lost)), i -> slice(_lines, "
        "if(i = 0, 1, _lost[i - 1] + 2), "
        "if(i = size(_lost), size(_lines), _lost[i]) - if(i = 0, 0, _lost[i - 1] + 1)))"
    )
    return found.select(
        "doc_id",
        F.when(F.col("_lost").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(between), "\n")).alias("text"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_lost"), F.lit(0)).cast("long").alias("n_dropped"),
    )
