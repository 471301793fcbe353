"""Scalar functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
LOCAL_HOURS = 7  # the home time zone is UTC+7 all year


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance, in the atan2 form."""
    half_lat, half_lon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.sin(half_lat) * F.sin(half_lat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(half_lon) * F.sin(half_lon)
    return F.lit(2 * EARTH_KM) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def round_half_up(x: Column, digits: int) -> Column:
    """floor(x * 10**digits + .5) / 10**digits."""
    k = float(10**digits)
    return F.floor(x * k + 0.5) / k


def local_hour(ms: Column) -> Column:
    """Hour of the day in the home time zone; 12 where there is no time."""
    return F.when(ms > 0, F.pmod(F.floor(ms / 3_600_000) + LOCAL_HOURS, F.lit(24))).otherwise(12).cast("int")


def non_blank(x: Column, default: str) -> Column:
    return F.when(F.trim(x) != "", x).otherwise(F.lit(default))


def from_millis(ms: Column) -> Column:
    """Epoch milliseconds as a time without zone, whatever the session's zone is."""
    return F.timestamp_add("MILLISECOND", ms, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def to_millis(ts: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def start_of_minute(ts: Column) -> Column:
    return F.date_trunc("MINUTE", ts).cast("timestamp_ntz")


def valid_coordinates(lat: Column, lon: Column) -> Column:
    """On the globe, and not the (0, 0) of missing locations."""
    return lat.between(-90, 90) & lon.between(-180, 180) & ~((lat == 0) & (lon == 0))


def is_foreign(lat: Column, lon: Column) -> Column:
    """0 inside the home country's box, else 1."""
    return F.when(lat.between(8.0, 23.5) & lon.between(102.0, 110.0), 0).otherwise(1)
