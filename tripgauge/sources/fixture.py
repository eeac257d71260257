"""Raw trip records derived from the driver's ``events`` table.

Deterministic integer/double arithmetic only, so any SQL engine computes the
same rows. Output uses mixed column spellings on purpose (``tpep_*``,
``start_*``, ``end_*``) so column normalisation is exercised. ``event_id``
passes through as a unique tie-break for trip numbering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge.session import materialize, table_path


def trips_from_events(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    u = F.col("user_id")
    hr = F.hour("ts").cast("long")
    s = ((e * 131) % 16 + 1).cast("double")
    dy = ((e * 3571) % 2001 - 1000).cast("double") * s / F.lit(1e5)
    dx = ((e * 5417) % 2003 - 1001).cast("double") * s / F.lit(1e5)
    plat = F.lit(40.6) + ((e * 7919 + u * 104729) % 2000).cast("double") / F.lit(1e4)
    plon = F.lit(-74.05) + ((e * 6101 + u * 15485863) % 2000).cast("double") / F.lit(1e4)
    km = F.abs(dy) * F.lit(111.0) + F.abs(dx) * F.lit(84.0)
    dur = (F.when(e % 83 == 0, F.lit(0).cast("long"))
           .when(e % 79 == 0, F.lit(9000).cast("long"))
           .otherwise(F.lit(60).cast("long")
                      + F.floor(km * (F.lit(90) + 6 * (12 - F.abs(12 - hr)))).cast("long")
                      + (e * 2909) % 240))
    dropoff = F.when(e % 89 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
        F.timestamp_add("SECOND", dur, F.col("ts")))
    start_lat = F.when(e % 97 == 0, F.lit(None).cast("double")).when(e % 71 == 0, F.lit(95.0)).otherwise(plat)
    end_lat = F.when(e % 73 == 0, plat).otherwise(plat + dy)
    end_lon = F.when(e % 73 == 0, plon).otherwise(plon + dx)
    return events.select(
        e.alias("event_id"),
        F.col("ts").alias("tpep_pickup_datetime"),
        dropoff.alias("tpep_dropoff_datetime"),
        start_lat.alias("start_lat"),
        plon.alias("start_lon"),
        end_lat.alias("end_lat"),
        end_lon.alias("end_lon"),
        (km / F.lit(1.609)).alias("trip_distance"),
    )


def load_raw_trips(spark: SparkSession, sf_dir: str, materialized: bool = False) -> DataFrame:
    """Raw trips for ``sf_dir``, derived as they are read; ``materialized`` writes them
    as a Parquet source table in the shared folder first."""
    raw = trips_from_events(spark.read.parquet(table_path(sf_dir, "events")))
    return materialize(raw, "raw_trips") if materialized else raw
