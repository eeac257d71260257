"""Duration estimates: median segment speed with global fallback, or joined predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.functions import bucket_rank, speed_kmh
from tripgauge.operators.ranking import exact_percentiles
from tripgauge.session import broadcast_if_small
from tripgauge.schema import BUCKET, BUCKET_LABELS, DISTANCE, DURATION, ESTIMATE, HOUR, MIN_PREDICTION_SEC, MIN_SEGMENT_TRIPS, TRIP_ID

# hour_of_day has 24 values and distance_bucket 5: the segment table is bounded.
MAX_SEGMENTS = 24 * len(BUCKET_LABELS)


def _moving(training: DataFrame) -> DataFrame:
    return (training.where((F.col(DURATION) > 0) & (F.col(DISTANCE) > 0))
            .withColumn("speed_kmh", speed_kmh(DISTANCE, DURATION)))


def speed_medians(training: DataFrame, approx: bool = False) -> DataFrame:
    """Median speed and trip count per (hour, bucket) and overall, in one percentile job.

    Rows: (level, hour_of_day, distance_bucket, median_speed_kmh, trip_count)
    with level 'segment' or 'overall' (segment keys null).
    """
    moving = _moving(training)
    entries = F.array(
        F.struct(F.lit(0).cast("byte").alias("_lvl"), F.col(HOUR).alias(HOUR),
                 bucket_rank(F.col(BUCKET)).cast("byte").alias("_b")),
        F.struct(F.lit(1).cast("byte").alias("_lvl"), F.lit(None).cast("int").alias(HOUR),
                 F.lit(None).cast("byte").alias("_b")))
    stacked = moving.select("speed_kmh", F.inline(entries))
    q = exact_percentiles(stacked, "speed_kmh", [0.5], by=["_lvl", HOUR, "_b"],
                          names=["median_speed_kmh"], approx=approx,
                          max_groups=MAX_SEGMENTS + 1, count_col="trip_count", name="speed_medians")
    level = F.when(F.col("_lvl") == 0, "segment").otherwise("overall")
    bucket = F.element_at(F.array(*[F.lit(b) for b in BUCKET_LABELS]), F.col("_b").cast("int"))
    return q.select(level.alias("level"), HOUR, bucket.alias(BUCKET), "median_speed_kmh", "trip_count")


def median_speeds(training: DataFrame, min_trips: int = MIN_SEGMENT_TRIPS, approx: bool = False,
                  medians: DataFrame | None = None) -> DataFrame:
    """(hour_of_day, distance_bucket, median_speed_kmh, trip_count) with >= min_trips trips."""
    medians = speed_medians(training, approx) if medians is None else medians
    return (medians.where((F.col("level") == "segment") & (F.col("trip_count") >= min_trips))
            .select(HOUR, BUCKET, "median_speed_kmh", F.col("trip_count").cast("long").alias("trip_count")))


def global_speed(training: DataFrame, approx: bool = False, medians: DataFrame | None = None) -> float | None:
    """Median speed over all moving training trips (one driver scalar)."""
    medians = speed_medians(training, approx) if medians is None else medians
    rows = medians.where(F.col("level") == "overall").select("median_speed_kmh").collect()
    return rows[0][0] if rows else None


def median_speed_eta(evaluation: DataFrame, speeds: DataFrame, overall: float | None) -> DataFrame:
    """LEFT JOIN segment medians, falling back to the global median.

    The median table has one row per (hour, bucket): at most 120 rows, checked
    before it is broadcast (a larger table would get a shuffle join instead).
    """
    ms = broadcast_if_small(speeds.select(HOUR, BUCKET, F.col("median_speed_kmh").alias("_ms")), MAX_SEGMENTS)
    speed = F.coalesce(F.col("_ms"), F.lit(overall).cast("double"))
    return (evaluation.join(ms, [HOUR, BUCKET], "left")
            .withColumn("estimated_speed_kmh", speed)
            .withColumn(ESTIMATE, F.col(DISTANCE) / F.nullif(F.col("estimated_speed_kmh") / F.lit(3600.0), F.lit(0.0)))
            .drop("_ms"))


def clamp_prediction(c, floor_sec: float = MIN_PREDICTION_SEC):
    """max(pred, floor) for non-null predictions; null stays null, NaN stays NaN."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNull(), F.lit(None).cast("double")).when(F.isnan(c), c).otherwise(
        F.greatest(c, F.lit(float(floor_sec))))


def dedupe_predictions(preds: DataFrame, order_col: str, key: str = TRIP_ID) -> DataFrame:
    """One row per key: the one with the greatest ``order_col`` (the "last" write).

    ``max_by`` is combined map-side, so a key with very many versions is
    reduced inside each task before the shuffle. Ties on ``order_col`` are
    broken by the remaining columns, so the result is deterministic.
    """
    rest = [c for c in preds.columns if c != key]
    ordering = F.struct(F.col(order_col), *[F.col(c) for c in rest if c != order_col])
    return (preds.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), ordering).alias("_v"))
            .select(key, *[F.col(f"_v.{c}").alias(c) for c in rest]))


def predictions_join(evaluation: DataFrame, preds: DataFrame, key: str = TRIP_ID) -> DataFrame:
    """Evaluation trips INNER JOIN predictions on the unique trip key."""
    return evaluation.join(preds.select(key, ESTIMATE), key)
