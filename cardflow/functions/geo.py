"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardflow.schema import EARTH_RADIUS_KM


def haversine_km(lat_1: Column, lon_1: Column, lat_2: Column, lon_2: Column) -> Column:
    """Kilometres between two points in degrees; null if any coordinate is null.

    The half-chord is clamped to 1: rounding can push antipodal points past it, and asin is
    NaN there.
    """
    half_lat = F.sin(F.radians(lat_2 - lat_1) / 2)
    half_lon = F.sin(F.radians(lon_2 - lon_1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat_1)) * F.cos(
        F.radians(lat_2)
    ) * half_lon * half_lon
    clamped = F.when(chord > 1.0, F.lit(1.0)).otherwise(chord)
    return F.asin(F.sqrt(clamped)) * (2 * EARTH_RADIUS_KM)
