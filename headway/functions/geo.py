"""Corridor geometry: distance, free-flow and congested travel time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Mean earth radius, and the shortest free-flow time a corridor may have.
EARTH_RADIUS_KM = 6371.0
MIN_FREE_FLOW_SECONDS = 60


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance between two points given in degrees."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * (half_lon * half_lon)
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))


def whole_metres(km: Column) -> Column:
    return (km * 1000).cast("int")


def free_flow_seconds(km: Column, speed_limit_kmh: Column) -> Column:
    return F.greatest((km / speed_limit_kmh * 3600).cast("int"), F.lit(MIN_FREE_FLOW_SECONDS))


def congested_seconds(free_flow: Column, ratio: Column) -> Column:
    return (free_flow * ratio).cast("int")
