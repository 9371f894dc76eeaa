"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from staylens.functions.stay import round_places

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Distance in km to the metre; NULL when any coordinate is NULL."""
    half_dlat = F.radians(lat_a - lat_b) / 2
    half_dlon = F.radians(lon_a - lon_b) / 2
    chord = F.pow(F.sin(half_dlat), F.lit(2)) + F.cos(F.radians(lat_b)) * F.cos(
        F.radians(lat_a)
    ) * F.pow(F.sin(half_dlon), F.lit(2))
    return round_places(2 * EARTH_RADIUS_KM * F.asin(F.sqrt(chord)), 3)
