"""The four workflow steps as job functions: load, train, score, analyse.

Each composes the operators end to end and writes its outputs; the median
speed estimate is a fifth, SQL-only variant of "score". Paths may be any
Hadoop-compatible location; table formats are Parquet (or JDBC / CSV where
noted).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge import schema as S
from tripgauge.operators.charts import calibration_bins, error_histograms, histogram_markers
from tripgauge.operators.insights import best_worst_segment, bias_detection, overall_insight
from tripgauge.operators.metrics import compare_methods, error_by_segment, error_quantiles, metrics_tables, segment_metrics
from tripgauge.operators.model import count_trees, load_model, model_mae, save_model, train_duration_model
from tripgauge.operators.split import model_input, temporal_validation_split
from tripgauge.plans.evaluation import TripEvaluation
from tripgauge.session import materialize
from tripgauge.sources.files import list_names
from tripgauge.sources.readers import first_n, read_trips
from tripgauge.sources.sinks import verify_row_count, write_metrics_csv, write_predictions, write_trips_table
from tripgauge.sources.triptable import TripTable


def load_trips(ev: TripEvaluation, target: str, mode: str = "replace") -> int:
    """Write the clean trips and verify the table's row count; ``append`` continues the stored numbering, or creates the table."""
    spark, clean, before = ev.spark, ev.clean, 0
    if mode == "append" and list_names(spark, target):
        held = spark.read.parquet(target).agg(F.count(F.lit(1)).alias("n"), F.max(S.TRIP_ID).alias("top")).first()
        before = held["n"]
        clean = clean.withColumn(S.TRIP_ID, F.col(S.TRIP_ID) + F.lit(held["top"] or 0))
    written = write_trips_table(clean, target, mode)
    verify_row_count(spark.read.parquet(target), before + written)
    return written


def load_versioned(ev: TripEvaluation, target: str, load_id: str, mode: str = "append") -> dict:
    """The clean trips as the load ``load_id`` of a ``TripTable``: atomic, repeatable, ids in pickup order over all loads.

    ``append`` or ``replace``; content is verified before the load becomes visible. Returns the table's snapshot.
    """
    table = TripTable(ev.spark, target, ev.tiebreak)
    return {"append": table.append, "replace": table.replace}[mode](ev.clean, load_id)


def load_job(spark: SparkSession, source: str, target: str, fmt: str = "csv", mode: str = "replace",
             schema=None, sample_size: int | None = None, bbox: bool = False,
             tiebreak: tuple[str, ...] = (), load_id: str | None = None) -> dict:
    """Raw trip files -> trips_clean table. Returns the filter statistics.

    With a ``load_id`` the target is a ``TripTable``: a failed load leaves it as
    it was, a repeated one changes nothing, and ids follow pickup order over all loads.

    ``append`` numbers on from the stored maximum, so ids stay dense and unique
    over all loads. The table's row count is verified in every mode.
    """
    raw = read_trips(spark, source, fmt, schema)
    if sample_size:
        raw = first_n(raw, sample_size)
    ev = TripEvaluation(spark, raw, bbox=bbox, tiebreak=tiebreak)
    if load_id is None:
        written = load_trips(ev, target, mode)
    else:
        written = next(load["rows"] for load in load_versioned(ev, target, load_id, mode)["loads"] if load["id"] == load_id)
    stats = ev.quality_report()  # observed while numbering: no extra pass over the source
    total, kept = sum(stats.values()), stats.get("ok", 0)
    return {"rejects": stats, "initial_count": total, "final_count": kept, "filtered_out": total - kept,
            "retention_rate": kept / total if total else 0.0, "written": written}


def _evaluation(spark: SparkSession, clean_table: str) -> TripEvaluation:
    return TripEvaluation.from_clean(spark, spark.read.parquet(clean_table))


def train_job(spark: SparkSession, clean_table: str, model_path: str, val_fraction: float = S.VALIDATION_FRACTION,
              **params) -> dict:
    """Fit the duration model on the training split; save it; report validation MAE."""
    ev = _evaluation(spark, clean_table)
    train = temporal_validation_split(model_input(ev.training), val_fraction)
    model = train_duration_model(train, **params)
    save_model(model, model_path)
    return {"validation_mae_sec": model_mae(model, train.where("is_val")),
            "trees": count_trees(model)}


def score_job(spark: SparkSession, clean_table: str, model_path: str, predictions_target: str,
              metrics_dir: str | None = None) -> DataFrame:
    """Score the evaluation split, store keyed predictions, compute and export the metrics.

    Rows are scored in-plan and the error rows materialised once; the keyed
    prediction table is written from them, so no join brings predictions back.
    """
    ev = _evaluation(spark, clean_table)
    errors = ev.model_errors(load_model(model_path))
    write_predictions(errors.select(S.TRIP_ID, S.ESTIMATE), predictions_target)
    metrics = materialize(segment_metrics(errors), "model_metrics")
    if metrics_dir:
        write_metrics_csv(metrics_tables(metrics), metrics_dir)
    return metrics


def median_speed_job(spark: SparkSession, clean_table: str, metrics_dir: str | None = None) -> DataFrame:
    """The SQL-only variant: segment median speeds with global fallback as the estimate."""
    ev = _evaluation(spark, clean_table)
    if metrics_dir:
        write_metrics_csv(ev.tables(), metrics_dir)
    return ev.metrics


def comparison_job(spark: SparkSession, clean_table: str, model_path: str) -> DataFrame:
    """Metric rows of the stored model and of the median-speed baseline, told apart by ``method``."""
    ev = _evaluation(spark, clean_table)
    return compare_methods({"model": ev.model_errors(load_model(model_path)), "median_speed": ev.errors})


def analysis_job(spark: SparkSession, errors: DataFrame, out_dir: str | None = None) -> dict[str, DataFrame]:
    """Chart data and insights for a table of error rows."""
    q = materialize(error_quantiles(errors), "analysis_quantiles")
    metrics = segment_metrics(errors, qtable=q)
    out = {
        "error_histogram": error_histograms(errors, qtable=q),
        "histogram_markers": histogram_markers(errors, qtable=q),
        "calibration_bins": calibration_bins(errors, qtable=q),
        "overall_insight": overall_insight(metrics),
        "best_worst_segment": best_worst_segment(metrics, "distance_bucket").unionByName(
            best_worst_segment(metrics, "hour_of_day")),
        "bias_detection": bias_detection(errors),
        "error_by_distance": error_by_segment(metrics, "distance_bucket"),
        "error_by_hour": error_by_segment(metrics, "hour_of_day"),
    }
    if out_dir:
        for name, df in out.items():
            df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{out_dir.rstrip('/')}/{name}")
    return out
