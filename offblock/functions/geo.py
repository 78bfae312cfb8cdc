"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offblock.constants import EARTH_RADIUS_M


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Haversine metres (atan2 form)."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    dphi = F.radians(lat2 - lat1)
    dlmb = F.radians(lng2 - lng1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(EARTH_RADIUS_M) * (F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)))


def log_distance(d: Column) -> Column:
    """Natural log; 0 -> -infinity (Spark's ``ln(0)`` is NULL)."""
    return F.when(d == 0, F.lit(float("-inf"))).otherwise(F.ln(d))
