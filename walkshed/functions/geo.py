"""Distances on the sphere and the degree box around a station."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from walkshed.schema import EARTH_RADIUS_KM


def great_circle_km(
    lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column, cos_a: Column | None = None, cos_b: Column | None = None
) -> Column:
    """Haversine distance in km; the cosines of the latitudes can be given."""
    half_lat = F.sin(F.radians(lat_b - lat_a) / 2.0)
    half_lon = F.sin(F.radians(lon_b - lon_a) / 2.0)
    cos_a = F.cos(F.radians(lat_a)) if cos_a is None else cos_a
    cos_b = F.cos(F.radians(lat_b)) if cos_b is None else cos_b
    chord = half_lat * half_lat + cos_a * cos_b * half_lon * half_lon
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))


def inside_box(
    lat: Column, lon: Column, centre_lat: Column, centre_lon: Column, lat_tol: float, lon_tol: float
) -> Column:
    """Whether a point lies within the tolerances of a centre, edges included."""
    return lat.between(centre_lat - lat_tol, centre_lat + lat_tol) & lon.between(
        centre_lon - lon_tol, centre_lon + lon_tol
    )
