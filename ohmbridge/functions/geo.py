"""Geography as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; infinite if a coordinate is missing."""
    half = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    # least() would skip a null
    return F.when(half.isNull(), F.lit(float("inf"))).otherwise(2 * EARTH_KM * F.asin(F.sqrt(F.least(half, F.lit(1.0)))))


def in_box(lat: Column, lon: Column, box: dict) -> Column:
    return lat.between(box["min_lat"], box["max_lat"]) & lon.between(box["min_lon"], box["max_lon"])


def to_screen(lat: Column, lon: Column, box: dict[str, Column], width: int = 860, height: int = 560) -> tuple[Column, Column]:
    """Linear map position with a margin of 8 per cent, 0.05 degrees at least."""
    pad_lat = F.greatest(F.lit(0.05), (box["max_lat"] - box["min_lat"]) * 0.08)
    pad_lon = F.greatest(F.lit(0.05), (box["max_lon"] - box["min_lon"]) * 0.08)
    left, right = box["min_lon"] - pad_lon, box["max_lon"] + pad_lon
    low, high = box["min_lat"] - pad_lat, box["max_lat"] + pad_lat
    return (lon - left) / (right - left) * (width - 40) + 20, (high - lat) / (high - low) * (height - 60) + 20
