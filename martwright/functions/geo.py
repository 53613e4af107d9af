"""Distances on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius used by every distance in the marts.
EARTH_RADIUS_KM = 6371.0


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def haversine_km(
    lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str
) -> Column:
    """Great-circle distance in km between two points in degrees."""
    phi1, phi2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    half_lat = F.sin((phi2 - phi1) / 2)
    half_lon = F.sin((F.radians(_col(lon2)) - F.radians(_col(lon1))) / 2)
    chord = half_lat * half_lat + F.cos(phi1) * F.cos(phi2) * half_lon * half_lon
    # Rounding may push the term of antipodal points just above one; NULL stays NULL.
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.when(chord > 1.0, 1.0).otherwise(chord)))


def parse_decimal_comma(text: Column | str) -> Column:
    """A number written with a decimal comma; NULL when it is no number."""
    return F.regexp_replace(_col(text), ",", ".").try_cast("double")
