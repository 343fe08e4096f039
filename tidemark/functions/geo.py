"""Great-circle geometry as column expressions (M1-M3)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference's geometry.
EARTH_RADIUS_KM = 6371.0
NM_PER_KM = 0.539957
KM_PER_NM = 1.852


def _rad(x: Column) -> Column:
    return x * F.lit(math.pi) / 180


def _deg(x: Column) -> Column:
    return x * 180 / F.lit(math.pi)


def haversine_nm(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """M1: great-circle distance in nautical miles."""
    dlat = _rad(lat2 - lat1)
    dlon = _rad(lon2 - lon1)
    a = F.sin(dlat / 2) * F.sin(dlat / 2) + F.cos(_rad(lat1)) * F.cos(_rad(lat2)) * F.sin(dlon / 2) * F.sin(dlon / 2)
    c = 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))
    return F.lit(EARTH_RADIUS_KM) * c * F.lit(NM_PER_KM)


def bearing_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """M2: initial bearing in [0, 360)."""
    dlon = _rad(lon2 - lon1)
    y = F.sin(dlon) * F.cos(_rad(lat2))
    x = F.cos(_rad(lat1)) * F.sin(_rad(lat2)) - F.sin(_rad(lat1)) * F.cos(_rad(lat2)) * F.cos(dlon)
    return (_deg(F.atan2(y, x)) + 360) % 360


def dead_reckon(lat: Column, lon: Column, bearing: Column, distance_nm: Column) -> tuple[Column, Column]:
    """M3: destination (lat, lon) from a start, a bearing and a distance in nm."""
    d = distance_nm * F.lit(KM_PER_NM) / F.lit(EARTH_RADIUS_KM)
    th = _rad(bearing)
    p1 = _rad(lat)
    l1 = _rad(lon)
    p2 = F.asin(F.sin(p1) * F.cos(d) + F.cos(p1) * F.sin(d) * F.cos(th))
    l2 = l1 + F.atan2(F.sin(th) * F.sin(d) * F.cos(p1), F.cos(d) - F.sin(p1) * F.sin(p2))
    return _deg(p2), _deg(l2)
