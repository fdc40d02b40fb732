"""Great-circle distances (FN-20, GEO-01)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in miles, miles to kilometres, sphere radius in metres.
RADIUS_MILES = 3961
KM_PER_MILE = 1.60934
RADIUS_METRES = 6371010.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _central_angle(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat = F.radians(lat2 - lat1) / 2
    dlon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2)
    # Rounding may lift the chord of antipodes above 1.
    return 2 * F.asin(F.sqrt(F.when(chord > 1, F.lit(1.0)).otherwise(chord)))


def haversine_distance(
    lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str, unit: str = "mi"
) -> Column:
    """FN-20: haversine distance in miles (``mi``) or kilometres (``km``)."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    miles = _central_angle(*map(_col, (lat1, lon1, lat2, lon2))) * RADIUS_MILES
    return miles * KM_PER_MILE if unit == "km" else miles


def point_distance_m(
    lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str, radius: float = RADIUS_METRES
) -> Column:
    """GEO-01: distance between two points in metres; NULL when a coordinate is NULL.

    The reference hands (lat, lon) to a function that takes (lon, lat); here the arguments go by name.
    """
    return _central_angle(*map(_col, (lat1, lon1, lat2, lon2))) * radius
