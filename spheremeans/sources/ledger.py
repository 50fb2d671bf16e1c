"""Cleaning that says what it drops: points, and rejected lines by file and reason, from one scan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spheremeans.config import new_path
from spheremeans.functions import text
from spheremeans.operators.filters import decimal_shaped, has_fields, nonzero
from spheremeans.sources.lines import read_lines

# Reasons, in the order in which they are looked for.
FIELDS = "number of fields"
NO_NUMBER = "latitude is no number"
ZERO = "latitude is zero"
LAT_NO_DECIMAL = "latitude is no decimal number"
LON_NO_DECIMAL = "longitude is no decimal number"
REASONS = (FIELDS, NO_NUMBER, ZERO, LAT_NO_DECIMAL, LON_NO_DECIMAL)


@dataclass(frozen=True)
class Layout:
    """How lines are split, which fields are the coordinates, and why a line is rejected."""

    pattern: str
    needed: int
    latitude: int
    longitude: int
    skip_first: bool
    rules: Callable[[str | None], list[tuple[Column, str]]]


def _numbers(zero: str | None) -> list[tuple[Column, str]]:
    rules = [(text.to_double("latitude").isNull(), NO_NUMBER), (~nonzero("latitude", zero or "exact"), ZERO)]
    return rules if zero else []


LAYOUTS = {
    "space": Layout(text.SPACES, 3, 0, 1, True, lambda zero: [(~has_fields("parts", 3), FIELDS), *_numbers(zero)]),
    "device": Layout(text.COMMA_PIPE_SLASH, 14, 12, 13, False, _numbers),
    "tab": Layout(text.TAB, 2, 0, 1, True, _numbers),
    "comma": Layout(
        text.COMMA, 2, 0, 1, False,
        lambda zero: [(~decimal_shaped(c) | F.col(c).isNull(), why) for c, why in (("latitude", LAT_NO_DECIMAL), ("longitude", LON_NO_DECIMAL))],
    ),
}

# What the cleaning pipelines do with zero latitudes if they are not told.
ZERO_FILTERS = {"space": None, "device": "exact", "tab": "exact", "comma": None}


@dataclass
class Cleaned:
    """``points`` as the cleaning pipeline gives them; ``rejected`` lines with file and reason;
    ``totals`` of lines by reason, and of kept ones under None, as observed by the scan."""

    points: DataFrame
    rejected: DataFrame
    totals: dict[str | None, int]
    path: str

    def ledger(self) -> DataFrame:
        """file, reason, n_lines and an example of each."""
        return self.rejected.groupBy("file", "reason").agg(
            F.count(F.lit(1)).alias("n_lines"), F.min("line").alias("example")
        )


def judged_lines(
    spark: SparkSession, path: str | list[str], layout: str, zero_filter: str | None = None, skip_first: bool | None = None
) -> DataFrame:
    """latitude, longitude, file, reason (null: kept) and, of rejected ones, the line."""
    how = LAYOUTS[layout]
    lines = read_lines(spark, path, how.skip_first if skip_first is None else skip_first, with_file=True)
    split = lines.select("file", "value", text.fields("value", how.pattern, how.needed).alias("parts"))
    found = split.select(
        "*", F.get("parts", F.lit(how.latitude)).alias("latitude"), F.get("parts", F.lit(how.longitude)).alias("longitude")
    )
    reason = F.lit(None).cast("string")
    for fails, why in reversed(how.rules(zero_filter or ZERO_FILTERS[layout])):
        reason = F.when(fails, why).otherwise(reason)
    found = found.withColumn("reason", reason)
    return found.select(
        text.to_double("latitude").alias("latitude"), text.to_double("longitude").alias("longitude"),
        "file", "reason", F.when(F.col("reason").isNotNull(), F.col("value")).alias("line"),
    )


def clean_with_ledger(
    spark: SparkSession, path: str | list[str], layout: str, zero_filter: str | None = None, skip_first: bool | None = None
) -> Cleaned:
    """Clean files of one layout (``space``, ``device``, ``tab``, ``comma``) and account for every line.

    The files are read once: kept points and rejected lines go to two parts of one table in the
    shared folder, of which later reads touch only the part that they need.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}, expected one of {sorted(LAYOUTS)}")
    judged = judged_lines(spark, path, layout, zero_filter, skip_first)
    seen = Observation()
    counts = [F.count_if(F.col("reason") == why).alias(why) for why in REASONS]
    watched = judged.observe(seen, F.count(F.lit(1)).alias("lines"), *counts)
    table = new_path(spark, f"cleaned-{layout}")
    watched.withColumn("rejected", F.col("reason").isNotNull()).write.partitionBy("rejected").parquet(table)
    stored = spark.read.schema(f"{judged._jdf.schema().toDDL()}, rejected boolean").parquet(table)
    totals: dict[str | None, int] = {why: seen.get[why] for why in REASONS if seen.get[why]}
    totals[None] = seen.get["lines"] - sum(totals.values())
    return Cleaned(
        stored.where("NOT rejected").select("latitude", "longitude"),
        stored.where("rejected").select("file", "reason", "line"),
        totals,
        table,
    )
