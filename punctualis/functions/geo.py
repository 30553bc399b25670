"""Distances on the sphere from plain latitude and longitude columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
EARTH_M = 6371008.8


def _col(c) -> Column:
    if isinstance(c, Column):
        return c
    return F.col(c) if isinstance(c, str) else F.lit(float(c))


def central_angle(lat1, lon1, lat2, lon2) -> Column:
    """Angle in radians between two points (haversine form)."""
    a1, a2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    half_lat = F.sin((a2 - a1) / 2)
    half_lon = F.sin(F.radians(_col(lon2) - _col(lon1)) / 2)
    h = half_lat * half_lat + F.cos(a1) * F.cos(a2) * half_lon * half_lon
    return 2 * F.atan2(F.sqrt(h), F.sqrt(1 - h))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    return central_angle(lat1, lon1, lat2, lon2) * EARTH_KM


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    return central_angle(lat1, lon1, lat2, lon2) * EARTH_M


def wkt_point(lon, lat) -> Column:
    """``POINT(lon lat)`` text."""
    return F.concat(F.lit("POINT("), _col(lon).cast("string"), F.lit(" "), _col(lat).cast("string"), F.lit(")"))
