"""Headline insights read off the metric rows and the error rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgauge.functions import bucket_rank
from tripgauge.schema import BIAS_THRESHOLD_SEC, WEEKDAY_LABELS


def overall_insight(metrics: DataFrame) -> DataFrame:
    """Median / P90 absolute error (seconds and percent) and share within 10%."""
    return metrics.where(F.col("segment_type") == "overall").select(
        F.col("medae_sec").alias("median_abs_error_sec"),
        (F.col("medae_pct") * 100).alias("median_abs_error_pct"),
        F.col("p90_abs_error_sec").alias("p90_abs_error_sec"),
        (F.col("p90_abs_error_pct") * 100).alias("p90_abs_error_pct"),
        (F.col("pct_within_10pct") * 100).alias("share_within_10pct"))


def _segment_rank(segment_type: str) -> Column:
    v = F.col("segment_value")
    if segment_type == "distance_bucket":
        return bucket_rank(v)
    if segment_type == "hour_of_day":
        return v.try_cast("int")
    if segment_type == "day_of_week":
        return F.array_position(F.array(*[F.lit(d) for d in WEEKDAY_LABELS]), v).cast("int")
    return F.lit(0)


def best_worst_segment(metrics: DataFrame, segment_type: str) -> DataFrame:
    """Segments with the lowest and highest median relative error; ties go to the earlier segment."""
    rows = metrics.where(F.col("segment_type") == segment_type).withColumn("_rk", _segment_rank(segment_type))
    best_key = F.struct(F.col("medae_pct"), F.col("_rk"), F.col("segment_value"))
    worst_key = F.struct(F.col("medae_pct"), -F.col("_rk"), F.col("segment_value"))
    return rows.groupBy("segment_type").agg(
        F.min_by("segment_value", best_key).alias("best_segment"),
        F.min("medae_pct").alias("best_medae_pct"),
        F.max_by("segment_value", worst_key).alias("worst_segment"),
        F.max("medae_pct").alias("worst_medae_pct"))


def bias_detection(errors: DataFrame, threshold: float = BIAS_THRESHOLD_SEC) -> DataFrame:
    """Mean signed error; 'overestimate' / 'underestimate' beyond +-threshold seconds, else 'none'."""
    m = F.col("mean_error_sec")
    return errors.agg(F.avg("error_sec").alias("mean_error_sec")).select(
        "mean_error_sec", F.abs(m).alias("abs_mean_error_sec"),
        F.when(F.abs(m) > F.lit(float(threshold)), F.when(m > 0, "overestimate").otherwise("underestimate"))
        .otherwise("none").alias("direction"))
