"""Per-trip column functions (C4-C7, C10), all native expressions, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0

# Right-closed bucket edges and labels.
TRIP_LENGTH_BINS = (0.0, 1.0, 3.0, 100.0)
TRIP_LENGTH_LABELS = ("short", "medium", "long")
DURATION_BINS = (0.0, 5.0, 15.0, 30.0, 60.0, 1440.0)
DURATION_LABELS = ("very_short", "short", "medium", "long", "very_long")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """C4: great-circle distance in km."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dlat = p2 - p1
    dlon = F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2.0) * F.asin(F.sqrt(a)) * F.lit(EARTH_RADIUS_KM)


def right_closed_bucket(x: Column, edges, labels) -> Column:
    """Label of the (edges[i], edges[i+1]] bin holding x; null outside (0 included)."""
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > lo) & (x <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def trip_length_bucket(distance_km: Column) -> Column:
    """C5."""
    return right_closed_bucket(distance_km, TRIP_LENGTH_BINS, TRIP_LENGTH_LABELS)


def trip_duration_minutes(started: Column, ended: Column) -> Column:
    """(ended - started) in minutes, microsecond exact."""
    return F.timestamp_diff("MICROSECOND", started, ended) / F.lit(60_000_000.0)


def duration_bucket(minutes: Column) -> Column:
    """C7."""
    return right_closed_bucket(minutes, DURATION_BINS, DURATION_LABELS)


def round_trip(start_station: Column, end_station: Column) -> Column:
    """1 when a trip ends where it started (unknown end -> 0)."""
    return F.coalesce((start_station == end_station), F.lit(False)).cast("int")
