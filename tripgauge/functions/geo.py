"""Great-circle distance as a native expression (stays inside codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripgauge.schema import EARTH_RADIUS_KM


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in km; null in -> null out."""
    lat1, lon1, lat2, lon2 = (F.radians(F.col(c) if isinstance(c, str) else c)
                              for c in (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin((lat2 - lat1) / 2), 2)
         + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2))
    return F.lit(EARTH_RADIUS_KM) * (2 * F.atan2(F.sqrt(a), F.sqrt(1 - a)))
