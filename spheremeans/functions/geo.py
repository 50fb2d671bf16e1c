"""Distances on the sphere as Column expressions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the sphere radius in kilometres.
EARTH_RADIUS_KM = 6371.0

# The accepted spellings of each metric.
METRICS = {"euclidean": "chord", "euclidian": "chord", "haversine": "haversine"}


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def cartesian(lat: Column | str, lon: Column | str) -> tuple[Column, Column, Column]:
    """Degrees to x, y, z kilometres from the sphere's centre."""
    phi, lam = F.radians(_col(lat)), F.radians(_col(lon))
    radius = F.lit(EARTH_RADIUS_KM)
    return radius * F.cos(phi) * F.cos(lam), radius * F.cos(phi) * F.sin(lam), radius * F.sin(phi)


def chord_km(
    lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str
) -> Column:
    """Straight-line distance through the sphere."""
    deltas = [b - a for a, b in zip(cartesian(lat1, lon1), cartesian(lat2, lon2), strict=True)]
    return F.sqrt(deltas[0] * deltas[0] + deltas[1] * deltas[1] + deltas[2] * deltas[2])


def haversine_km(
    lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str
) -> Column:
    """Great-circle distance.

    Rounding can push the haversine term just above 1 for antipodes, where the
    second square root would be NaN, so it is clamped.
    """
    phi1, phi2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    half_dphi = (phi2 - phi1) / 2.0
    half_dlam = (F.radians(_col(lon2)) - F.radians(_col(lon1))) / 2.0
    a = F.sin(half_dphi) * F.sin(half_dphi) + F.cos(phi1) * F.cos(phi2) * F.sin(half_dlam) * F.sin(
        half_dlam
    )
    a = F.when(a > 1.0, 1.0).otherwise(a)
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(1.0 - a))


def distance_km(
    metric: str, lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str
) -> Column:
    """The distance named by ``metric``."""
    if METRICS.get(metric) == "chord":
        return chord_km(lat1, lon1, lat2, lon2)
    if METRICS.get(metric) == "haversine":
        return haversine_km(lat1, lon1, lat2, lon2)
    raise ValueError(f"unknown metric {metric!r}, expected one of {sorted(METRICS)}")


def moves_km(metric: str, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """``distance_km`` between rows of (latitude, longitude) held by the driver, such as centroids."""
    (phi1, lam1), (phi2, lam2) = np.radians(old).T, np.radians(new).T
    if METRICS[metric] == "haversine":
        a = np.sin((phi2 - phi1) / 2) ** 2 + np.cos(phi1) * np.cos(phi2) * np.sin((lam2 - lam1) / 2) ** 2
        a = np.minimum(a, 1.0)
        return 2 * EARTH_RADIUS_KM * np.arctan2(np.sqrt(a), np.sqrt(1 - a))
    ends = [(np.cos(p) * np.cos(m), np.cos(p) * np.sin(m), np.sin(p)) for p, m in ((phi1, lam1), (phi2, lam2))]
    return EARTH_RADIUS_KM * np.sqrt(sum((b - a) ** 2 for a, b in zip(*ends, strict=True)))


def is_located(lat: Column | str, lon: Column | str) -> Column:
    """True where both coordinates are present finite numbers.

    Written so that a scan can be told to skip missing coordinates.
    """
    lat, lon, bound = _col(lat), _col(lon), F.lit(float("inf"))
    return lat.isNotNull() & lon.isNotNull() & (F.abs(lat) < bound) & (F.abs(lon) < bound)
