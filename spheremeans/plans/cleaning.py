"""The three cleaning pipelines, from a raw file to typed points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spheremeans.functions.text import to_double
from spheremeans.operators.filters import keep_decimal_points, nonzero
from spheremeans.sources import lines


def clean_place_lines(
    spark: SparkSession,
    path: str | list[str],
    skip_first: bool = True,
    zero_filter: str | None = None,
) -> DataFrame:
    """Three space-separated fields. Zero latitudes stay unless a mode is given."""
    found = lines.read_space_fields(spark, path, skip_first)
    if zero_filter:
        found = found.filter(nonzero("latitude", zero_filter))
    return lines.typed_points(found)


def device_records(
    spark: SparkSession,
    path: str | list[str],
    skip_first: bool = False,
    zero_filter: str = "exact",
) -> DataFrame:
    """``date, deviceId, latitude, longitude, manufacturer, model``, zero latitudes out."""
    found = lines.read_device_fields(spark, path, skip_first)
    kept = lines.split_device_name(found.filter(nonzero("latitude", zero_filter)))
    return kept.select(
        "date",
        "deviceId",
        to_double("latitude").alias("latitude"),
        to_double("longitude").alias("longitude"),
        "manufacturer",
        "model",
    )


def clean_device_lines(
    spark: SparkSession,
    path: str | list[str],
    skip_first: bool = False,
    zero_filter: str = "exact",
) -> DataFrame:
    return device_records(spark, path, skip_first, zero_filter).select("latitude", "longitude")


def clean_tab_lines(
    spark: SparkSession,
    path: str | list[str],
    skip_first: bool = True,
    zero_filter: str = "exact",
) -> DataFrame:
    found = lines.read_tab_fields(spark, path, skip_first)
    return lines.typed_points(found.filter(nonzero("latitude", zero_filter)))


def clean_comma_lines(
    spark: SparkSession, path: str | list[str], skip_first: bool = False
) -> DataFrame:
    """Comma-separated text whose first two fields are decimal numbers."""
    return lines.typed_points(
        keep_decimal_points(lines.read_comma_fields(spark, path, skip_first))
    )
