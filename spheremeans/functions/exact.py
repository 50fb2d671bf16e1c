"""Sums of degrees that do not depend on the order in which they are added.

A number is cut into whole degrees and three binary limbs of 20 digits, each a small
integer. Integers add up exactly, so any partitioning, retry or pre-aggregation gives the same
sums, and the mean is one formula over them. What lies below 2**-60 of a degree is cut off.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMBS = 4
LIMB = float(1 << 20)

# Numbers beyond so many degrees count as so many; sums of 9e12 of them fit 64 bits.
MOST_DEGREES = 1e6


def limb_names(name: str) -> list[str]:
    return [f"_{name}_{i}" for i in range(LIMBS)]


def with_limbs(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with the limbs of double columns, from whole degrees down."""
    rest = {n: F.greatest(F.lit(-MOST_DEGREES), F.least(F.lit(MOST_DEGREES), F.col(n))) for n in names}
    df = df.withColumns({f"_{n}_rest": c for n, c in rest.items()})
    for i in range(LIMBS):
        df = df.withColumns({f"_{n}_{i}": F.col(f"_{n}_rest").cast("bigint") for n in names})
        if i < LIMBS - 1:
            df = df.withColumns({f"_{n}_rest": (F.col(f"_{n}_rest") - F.col(f"_{n}_{i}")) * LIMB for n in names})
    return df.drop(*(f"_{n}_rest" for n in names))


def limb_sums(*names: str) -> list[Column]:
    return [F.sum(c).alias(c) for n in names for c in limb_names(n)]


def mean_of(name: str, count: str) -> Column:
    """The mean from summed limbs."""
    return (_joined(F.col(c).cast("double") for c in limb_names(name)) / F.col(count)).alias(name)


def means_of(sums: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The same from rows of summed limbs held by the driver."""
    return _joined(sums[:, i].astype(np.float64) for i in range(LIMBS)) / n


def _joined(limbs):
    whole, first, second, third = limbs
    return whole + (first + (second + third / LIMB) / LIMB) / LIMB
