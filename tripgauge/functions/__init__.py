"""Column-level helpers: every function returns a native Spark ``Column``."""

from tripgauge.functions.geo import haversine_km
from tripgauge.functions.segments import (
    bucket_rank, distance_bucket, speed_kmh, weekday_label,
)
from tripgauge.functions.timefns import (
    day_of_week, duration_seconds, epoch_micros, epoch_seconds, parse_timestamp,
)

__all__ = [
    "haversine_km", "bucket_rank", "distance_bucket", "speed_kmh", "weekday_label",
    "day_of_week", "duration_seconds", "epoch_micros", "epoch_seconds", "parse_timestamp",
]
