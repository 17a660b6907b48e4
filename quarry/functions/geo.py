"""Geographic expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reference point (distribution centre) and mean earth radius in km.
CENTRE_LATITUDE = -34.6037
CENTRE_LONGITUDE = -58.3816
EARTH_RADIUS_KM = 6371


def haversine_km(
    latitude: Column,
    longitude: Column,
    from_latitude: float = CENTRE_LATITUDE,
    from_longitude: float = CENTRE_LONGITUDE,
) -> Column:
    """Great-circle distance to a fixed point, in km with one decimal."""
    half_lat = F.radians(latitude - F.lit(from_latitude)) / 2
    half_lon = F.radians(longitude - F.lit(from_longitude)) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(F.lit(from_latitude))) * F.cos(
        F.radians(latitude)
    ) * F.pow(F.sin(half_lon), 2)
    return F.round(2 * EARTH_RADIUS_KM * F.asin(F.sqrt(chord)), 1)


def geo_point(latitude: Column, longitude: Column, decimals: int | None = None) -> Column:
    """'lat,lon' text; NULL when either is missing."""
    if decimals is not None:
        latitude = latitude.cast(f"decimal(12,{decimals})")
        longitude = longitude.cast(f"decimal(12,{decimals})")
    return F.concat(latitude.cast("string"), F.lit(","), longitude.cast("string"))
