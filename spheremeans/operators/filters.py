"""Record filters of the cleaning step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spheremeans.functions.text import DECIMAL_SHAPE, to_double


def has_fields(parts: Column | str, n: int) -> Column:
    """Exactly ``n`` fields. Split with room for one more, or longer lines pass."""
    return F.size(parts) == n


def decimal_shaped(value: Column | str) -> Column:
    """Text that starts like a decimal number and is one.

    Requiring a decimal point drops header words and whole numbers. Text with a
    numeric start and a bad tail, such as ``12.5abc``, has no value and goes too.
    """
    c = F.col(value) if isinstance(value, str) else value
    return c.rlike(DECIMAL_SHAPE) & to_double(c).isNotNull()


def nonzero(value: Column | str, mode: str = "exact") -> Column:
    """Text with a non-zero number in it.

    ``exact`` compares the number itself. ``truncate`` compares its whole part,
    so everything strictly between -1 and 1 counts as zero.
    """
    number = to_double(value)
    if mode == "exact":
        return number != F.lit(0.0)
    if mode == "truncate":
        return F.abs(number) >= F.lit(1.0)
    raise ValueError(f"unknown mode {mode!r}, expected 'exact' or 'truncate'")


def keep_decimal_points(
    df: DataFrame, lat: str = "latitude", lon: str = "longitude"
) -> DataFrame:
    """Rows whose two text coordinates are both decimal numbers."""
    return df.filter(decimal_shaped(lat) & decimal_shaped(lon))
