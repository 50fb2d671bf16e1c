"""Readers for delimited point files.

Each returns text fields or typed points; none collects anything. Paths go
straight to Spark, so any file system known to the cluster works.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spheremeans.functions import text
from spheremeans.operators.filters import has_fields


def read_lines(
    spark: SparkSession, path: str | list[str], skip_first: bool = False, with_file: bool = False
) -> DataFrame:
    """One row per line that is not blank, column ``value``, and ``file``, its path, if asked.

    With ``skip_first`` the first line of every file is left out. Spark only does
    that for CSV, hence a CSV scan of one column. A line that holds the separator
    has too many columns; the scan then hands it over whole as a corrupt record.
    Lines of white space and control characters alone are dropped either way.
    """
    if skip_first:
        lines = (
            spark.read.schema("value string, _corrupt_record string")
            .options(
                header=True, sep="\u0001", quote="", escape="", lineSep="\n", mode="PERMISSIVE",
                columnNameOfCorruptRecord="_corrupt_record",
            )
            .csv(path)
        )
        value = F.coalesce("_corrupt_record", "value").alias("value")
    else:
        lines = spark.read.option("lineSep", "\n").text(path)
        value = F.col("value")
    file = [F.col("_metadata.file_path").alias("file")] if with_file else []
    lines = lines.select(value, *file)
    return lines.filter(F.col("value").rlike(text.NOT_BLANK))


def read_pipe_points(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Cleaned points, ``latitude|longitude`` under a header.

    Fields after the second are ignored; text that is no number reads as null.
    """
    fields = (
        spark.read.schema("latitude string, longitude string")
        .options(header=True, sep="|", quote="", escape="", lineSep="\n", enforceSchema=True)
        .csv(path)
    )
    return typed_points(fields)


def split_fields(lines: DataFrame, pattern: str, names: dict[int, str]) -> DataFrame:
    """Pick fields by position, counted from 0; absent ones are null."""
    parts = text.fields("value", pattern, max(names) + 1)
    return lines.select(*[F.get(parts, F.lit(i)).alias(name) for i, name in names.items()])


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    pattern: str,
    names: dict[int, str],
    skip_first: bool,
) -> DataFrame:
    return split_fields(read_lines(spark, path, skip_first), pattern, names)


def read_space_fields(
    spark: SparkSession, path: str | list[str], skip_first: bool = True
) -> DataFrame:
    """Lines of exactly three fields between runs of spaces.

    A leading or trailing space makes an empty field, so such lines do not match.
    """
    lines = read_lines(spark, path, skip_first)
    parts = text.fields("value", text.SPACES, 3)
    return lines.select(parts.alias("parts")).filter(has_fields("parts", 3)).select(
        F.get("parts", F.lit(0)).alias("latitude"), F.get("parts", F.lit(1)).alias("longitude")
    )


def read_tab_fields(
    spark: SparkSession, path: str | list[str], skip_first: bool = True
) -> DataFrame:
    return read_delimited(
        spark, path, text.TAB, {0: "latitude", 1: "longitude"}, skip_first
    )


def read_comma_fields(
    spark: SparkSession, path: str | list[str], skip_first: bool = False
) -> DataFrame:
    """First two fields of a comma-separated line, quotes not interpreted."""
    return read_delimited(
        spark, path, text.COMMA, {0: "latitude", 1: "longitude"}, skip_first
    )


def read_device_fields(
    spark: SparkSession, path: str | list[str], skip_first: bool = False
) -> DataFrame:
    """Device status lines, fields between any of comma, pipe and slash."""
    names = {0: "date", 1: "device", 2: "deviceId", 12: "latitude", 13: "longitude"}
    return read_delimited(spark, path, text.COMMA_PIPE_SLASH, names, skip_first)


def split_device_name(df: DataFrame, column: str = "device") -> DataFrame:
    """``maker model`` into two columns; ``model`` is null for a one-word name."""
    words = F.split(column, " ")
    return df.withColumns(
        {"manufacturer": F.get(words, F.lit(0)), "model": F.get(words, F.lit(1))}
    ).drop(column)


def typed_points(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Two text columns to double columns ``latitude`` and ``longitude``."""
    return df.select(
        text.to_double(lat).alias("latitude"), text.to_double(lon).alias("longitude")
    )
