"""Points stored along a curve over the map, so that reading a box touches few row groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Binary digits of each coordinate in a curve key; 2**-16 of the map is about 600 m.
DIGITS = 16

# Shifts and masks that spread 16 binary digits to every other place of 32.
_SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def _steps(name: str, low: float, span: float) -> Column:
    """Number of the step of a coordinate, those off the map at its border."""
    last = (1 << DIGITS) - 1
    at = F.floor((F.col(name) - low) / span * (last + 1))
    return F.greatest(F.lit(0), F.least(F.lit(last), at)).cast("bigint")


def _spread(number: Column) -> Column:
    for shift, mask in _SPREAD:
        number = number.bitwiseOR(F.shiftleft(number, shift)).bitwiseAND(F.lit(mask))
    return number


def curve_key() -> Column:
    """Place on the Z-curve: binary digits of latitude and longitude by turns. Null without a place."""
    finite = lambda c: F.abs(c) < float("inf")
    key = F.shiftleft(_spread(_steps("latitude", -90.0, 180.0)), 1).bitwiseOR(_spread(_steps("longitude", -180.0, 360.0)))
    return F.when(finite("latitude") & finite("longitude"), key)


def write_along_curve(points: DataFrame, path: str, mode: str = "errorifexists", row_group_bytes: int = 16 << 20) -> None:
    """Parquet in the order of the curve: each file, and each row group, covers a small part of the map.

    Readers need nothing but a filter on latitude and longitude. A place with many rows is split up.
    """
    keyed = points.withColumns({"_curve": curve_key(), "_tie": F.monotonically_increasing_id()})
    dealt = keyed.repartitionByRange("_curve", "_tie").sortWithinPartitions("_curve")
    dealt.drop("_curve", "_tie").write.mode(mode).option("parquet.block.size", row_group_bytes).parquet(path)


def points_in_box(
    spark: SparkSession, path: str, south: float, north: float, west: float, east: float
) -> DataFrame:
    """Stored points within a box, borders included; west beyond east means over the 180° line."""
    stored = spark.read.parquet(path)
    found = stored.where(F.col("latitude").between(south, north))
    if west <= east:
        return found.where(F.col("longitude").between(west, east))
    return found.where((F.col("longitude") >= west) | (F.col("longitude") <= east))
