"""The workflow steps end to end on the sf0.001 fixture, through files."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from tripgauge.plans import jobs
from tripgauge.plans.catalog import RAW_CSV_SCHEMA, _raw_csv
from tripgauge.plans.evaluation import evaluation_for


def test_workflow(spark):
    ev = evaluation_for(spark, SF001)
    d = tempfile.mkdtemp(prefix="tg-jobs-")
    stats = jobs.load_job(spark, _raw_csv(spark, SF001), f"{d}/trips_clean", "csv", schema=RAW_CSV_SCHEMA)
    assert stats["written"] == ev.clean.count() == stats["final_count"]
    assert sum(stats["rejects"].values()) == stats["initial_count"]

    speed = jobs.median_speed_job(spark, f"{d}/trips_clean", f"{d}/speed_metrics")
    want = {(r["segment_type"], r["segment_value"]): r["medae_sec"] for r in ev.metrics.collect()}
    got = {(r["segment_type"], r["segment_value"]): r["medae_sec"] for r in speed.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)

    info = jobs.train_job(spark, f"{d}/trips_clean", f"{d}/model", max_iter=5, median_trees=1)
    assert info["trees"] >= 1 and info["validation_mae_sec"] > 0
    metrics = jobs.score_job(spark, f"{d}/trips_clean", f"{d}/model", f"{d}/predictions", f"{d}/metrics")
    overall = metrics.where(F.col("segment_type") == "overall").first()
    assert overall["trip_count"] == ev.evaluation.count()
    assert spark.read.option("header", True).csv(f"{d}/metrics/metrics_combined").count() == metrics.count()

    charts = jobs.analysis_job(spark, ev.errors, f"{d}/analysis")
    assert charts["calibration_bins"].count() == 19
    assert charts["error_by_distance"].count() == 5 and charts["error_by_hour"].count() == 24
    both = jobs.comparison_job(spark, f"{d}/trips_clean", f"{d}/model")
    assert {r["method"] for r in both.select("method").collect()} == {"model", "median_speed"}
    assert charts["bias_detection"].first()["direction"] in ("overestimate", "underestimate", "none")


def test_append_and_incomplete_stored_tables(spark):
    ev = evaluation_for(spark, SF001)
    d = tempfile.mkdtemp(prefix="tg-append-")
    for odd, mode in ((0, "replace"), (1, "append")):
        half = jobs.TripEvaluation(spark, ev.raw.where(F.col("event_id") % 2 == odd), tiebreak=("event_id",))
        jobs.load_trips(half, f"{d}/trips", mode)
    stored = spark.read.parquet(f"{d}/trips")
    ids = sorted(r["trip_id"] for r in stored.select("trip_id").collect())
    assert ids == list(range(1, ev.clean.count() + 1))
    again = jobs.TripEvaluation.from_clean(spark, stored.drop("hour_of_day", "day_of_week", "distance_bucket"))
    assert again.split_us == ev.split_us and again.evaluation.count() == ev.evaluation.count()
    assert again.clean.where("distance_bucket IS NULL").count() == 0


def test_blank_rows_do_not_pile_up(spark):
    """Equal blank rows stay out of the numbering sort but are counted."""
    ev = evaluation_for(spark, SF001)
    blank = ev.raw.limit(1).select(*[F.lit(None).cast(t).alias(c) for c, t in ev.raw.dtypes]).withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("_n")
    half = jobs.TripEvaluation(spark, ev.raw.unionByName(blank), tiebreak=("event_id",))
    report = half.quality_report()
    assert report["ok"] == ev.clean.count() and report["missing_datetime"] == ev.quality_report()["missing_datetime"] + 500
    assert half._numbered[0].count() == report["ok"]
