"""Distances on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def great_circle(lat1, lon1, lat2, lon2, radius: float = EARTH_KM) -> Column:
    """Haversine distance in the unit of ``radius``; arguments in degrees."""
    a1, o1, a2, o2 = (F.radians(_col(c)) for c in (lat1, lon1, lat2, lon2))
    half = (F.pow(F.sin((a2 - a1) / 2), F.lit(2))
            + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), F.lit(2)))
    return F.lit(2 * radius) * F.asin(F.sqrt(F.least(half, F.lit(1.0))))
