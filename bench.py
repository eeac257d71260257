"""Headline timings of the trip-evaluation pipeline.

Runs every stage on $BENCH_SF_DIR (default /root/testdata/sf0.1) with
local[$BENCH_CPUS] and prints one JSON line. Stages share materialised
intermediates exactly as a production run would (clean trips, error rows and
metric rows are written once and reused), so the total is the cost of one
end-to-end evaluation.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def _sf(path: str) -> float | None:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else None


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import functions as F

    from tripgauge.operators.audit import fanout_audit
    from tripgauge.operators.charts import calibration_bins, error_histograms, histogram_markers
    from tripgauge.operators.features import scaler_fit, trip_features
    from tripgauge.operators.insights import best_worst_segment, bias_detection
    from tripgauge.operators.metrics import segment_metrics
    from tripgauge.operators.model import predict_duration, train_duration_model
    from tripgauge.operators.split import model_input, temporal_validation_split
    from tripgauge.plans.evaluation import TripEvaluation
    from tripgauge.session import local_session, table_path

    spark = local_session(cpus, shuffle_partitions=int(cpus))
    if os.environ.get("BENCH_AQE") == "0":  # diagnostics only
        spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up, not timed

    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}

    def timed(name, fn):
        """Time one stage; a failure is recorded (time null) instead of aborting the run."""
        t0 = time.time()
        try:
            out = fn()
        except Exception as exc:  # noqa: BLE001 - reported in the JSON line
            times[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
            return None
        times[name] = round(time.time() - t0, 3)
        return out

    replicate = int(os.environ.get("BENCH_REPLICATE", "1"))
    if replicate > 1:
        # Scale check: the events table replicated with shifted ids (same timestamps,
        # so every pickup time repeats `replicate` times - a tie-heavy input).
        from tripgauge.session import materialize
        from tripgauge.sources.fixture import trips_from_events

        ev_src = spark.read.parquet(table_path(sf_dir, "events"))
        span = ev_src.agg(F.max("event_id")).first()[0] + 1
        big = ev_src.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(replicate - 1).cast("long")))).select(
            (F.col("event_id") + F.col("copy") * F.lit(span)).alias("event_id"), "ts",
            (F.col("user_id") + F.col("copy")).alias("user_id"), "event_type", "value", "props")
        ev = timed("load_raw_trips", lambda: TripEvaluation(spark, materialize(trips_from_events(big), "raw_trips")))
    else:
        ev = timed("load_raw_trips", lambda: TripEvaluation.from_sf_dir(spark, sf_dir))

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    timed("trips_clean", lambda: run(ev.clean))
    timed("quality_report", ev.quality_report)  # observed during the numbering pass
    timed("temporal_split", lambda: ev.split_us)
    timed("median_speeds", lambda: (ev.median_speeds.collect(), ev.global_speed))
    timed("eta_errors", lambda: run(ev.errors))
    timed("metrics_combined", lambda: ev.metrics.collect())
    timed("insights", lambda: (best_worst_segment(ev.metrics, "distance_bucket").collect(),
                               bias_detection(ev.errors).collect()))
    timed("error_histogram", lambda: (error_histograms(ev.errors, qtable=ev.error_quantiles).collect(),
                                      histogram_markers(ev.errors, qtable=ev.error_quantiles).collect()))
    timed("calibration_bins", lambda: calibration_bins(ev.errors, qtable=ev.error_quantiles).collect())
    orders = spark.read.parquet(table_path(sf_dir, "orders"))
    lineitem = spark.read.parquet(table_path(sf_dir, "lineitem"))
    timed("join_fanout_audit", lambda: fanout_audit(orders, lineitem, ["o_orderkey"], ["l_orderkey"]).collect())
    timed("scaler_fit", lambda: scaler_fit(trip_features(ev.training)).collect())

    def model():
        train = temporal_validation_split(model_input(ev.training))
        m = train_duration_model(train)
        run(predict_duration(m, model_input(ev.evaluation)))
        segment_metrics(ev.model_errors(m)).collect()

    if os.environ.get("BENCH_SKIP_MODEL") != "1":
        timed("train_score_metrics", model)
    total = round(sum(t for t in times.values() if t is not None), 3)
    result = {"metric": "end_to_end_evaluation", "value": total, "unit": "sec",
              "queries": times, "sf": _sf(sf_dir), "cpus": int(cpus), "replicate": replicate}
    try:
        result["trips_clean"] = ev.clean.count()
    except Exception:  # noqa: BLE001
        pass
    if errors:
        result["errors"] = errors
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
