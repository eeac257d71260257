"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the driver's tables (trips are derived from ``events``)
and runs over all of their rows. Presentation for the oracle comparison:
doubles rounded to 6 decimals, timestamps as epoch microseconds.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, TimestampNTZType, TimestampType

from tripgauge import schema as S
from tripgauge.functions import day_of_week, epoch_micros, speed_kmh, weekday_label
from tripgauge.operators.audit import fanout_audit, worst_keys
from tripgauge.operators.charts import calibration_bins, error_histograms, histogram_markers
from tripgauge.operators.columns import add_columns_if_absent, fill_derived
from tripgauge.operators.estimate import clamp_prediction, dedupe_predictions, predictions_join
from tripgauge.operators.errors import eta_errors
from tripgauge.operators.features import scaler_fit, standardize, trip_features
from tripgauge.operators.insights import best_worst_segment, bias_detection, overall_insight
from tripgauge.operators.metrics import (
    compare_methods, error_by_segment, error_quantiles, error_sketches, merged_error_sketches, metrics_tables, segment_metrics)
from tripgauge.operators.model import load_model, predict_duration, save_model, train_duration_model
from tripgauge.operators.quality import filter_stats, quality_rules, reject_reason, retention_summary
from tripgauge.operators.ranking import exact_percentiles, row_numbers
from tripgauge.operators.split import dataset_summary, model_input, split_labels, temporal_validation_split
from tripgauge.plans.evaluation import TripEvaluation, evaluation_for
from tripgauge.plans.jobs import load_trips
from tripgauge.session import materialize, stage_path, table_path
from tripgauge.sources.batches import read_batched, write_batched
from tripgauge.sources.bucketed import bucketed_predictions_join, write_bucketed
from tripgauge.sources.readers import first_n, read_trips, sample_trips
from tripgauge.sources.sinks import observed_content, verify_content, verify_row_count, write_metrics_csv, write_predictions, write_trips_table
from tripgauge.sources.triptable import TripTable

Query = Callable[[SparkSession, str], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Doubles rounded to 6 decimals, timestamps as epoch microseconds."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(f.dataType, TimestampNTZType):
            c = epoch_micros(c)
        elif isinstance(f.dataType, TimestampType):
            c = F.unix_micros(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _ev(spark, sf_dir):
    return evaluation_for(spark, sf_dir)


NORM_COLS = ["event_id", "pickup_datetime", "dropoff_datetime", "pickup_latitude", "pickup_longitude",
             "dropoff_latitude", "dropoff_longitude", "trip_distance"]
CLEAN_COLS = [S.TRIP_ID, "event_id", "pickup_datetime", "dropoff_datetime", S.DURATION, S.DISTANCE,
              S.HOUR, S.DOW, S.BUCKET]


def q_normalize_columns(spark, sf_dir):
    return present(_ev(spark, sf_dir).normalized.select(*NORM_COLS))


def q_scan_trips_csv(spark, sf_dir):
    """Raw trips through a headed CSV file in the shared folder and back."""
    from tripgauge.operators.columns import normalize_columns, parse_timestamps, require_columns

    path = _raw_csv(spark, sf_dir)
    back = parse_timestamps(require_columns(normalize_columns(read_trips(spark, path, "csv", RAW_CSV_SCHEMA))))
    return present(back.select(*NORM_COLS))


RAW_CSV_SCHEMA = ("event_id long, tpep_pickup_datetime string, tpep_dropoff_datetime string, start_lat double, "
                  "start_lon double, end_lat double, end_lon double, trip_distance double")


def _raw_csv(spark, sf_dir) -> str:
    raw = _ev(spark, sf_dir).raw
    path = stage_path(spark, "raw_trips_csv")
    (raw.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
     .mode("overwrite").csv(path))
    return path


def q_stream_clean_trips(spark, sf_dir):
    """Raw trip CSV files streamed through the quality cascade (several micro-batches)."""
    from tripgauge.streaming.ingest import read_stream_output, start_clean_trips_stream

    src = _raw_csv(spark, sf_dir)
    sink, ckpt = stage_path(spark, "stream_sink"), stage_path(spark, "stream_checkpoint")
    q = start_clean_trips_stream(spark, src, RAW_CSV_SCHEMA, sink, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    clean, _ = read_stream_output(spark, sink)
    return present(clean.select("event_id", "pickup_datetime", S.DURATION, S.DISTANCE, S.HOUR, S.DOW, S.BUCKET))


def q_stream_reject_counts(spark, sf_dir):
    from tripgauge.streaming.ingest import read_stream_output, start_clean_trips_stream

    src = _raw_csv(spark, sf_dir)
    sink, ckpt = stage_path(spark, "stream_sink"), stage_path(spark, "stream_checkpoint")
    q = start_clean_trips_stream(spark, src, RAW_CSV_SCHEMA, sink, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    return read_stream_output(spark, sink)[1]


def q_trip_duration(spark, sf_dir):
    return _ev(spark, sf_dir).measured.select("event_id", S.DURATION)


def q_haversine_km(spark, sf_dir):
    return present(_ev(spark, sf_dir).measured.select("event_id", S.DISTANCE))


def q_reject_reason(spark, sf_dir):
    return _ev(spark, sf_dir).labelled.select("event_id", "reject_reason")


def q_filter_stats(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    return filter_stats(ev.measured, ev.rules)


def q_retention_summary(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    return present(retention_summary(ev.measured, ev.rules))


def q_trips_clean(spark, sf_dir):
    return present(_ev(spark, sf_dir).clean.select(*CLEAN_COLS))


def q_write_trips_table(spark, sf_dir):
    """trips_clean through the table sink (replace mode, row count verified) and back."""
    clean = _ev(spark, sf_dir).clean.select(*CLEAN_COLS)
    path = stage_path(spark, "trips_clean_table")
    n = write_trips_table(clean, path, mode="replace")
    back = spark.read.parquet(path)
    verify_row_count(back, n)
    return present(back)


def q_fill_derived(spark, sf_dir):
    clean = _ev(spark, sf_dir).clean.drop(S.HOUR, S.DOW, S.BUCKET)
    return fill_derived(add_columns_if_absent(clean)).select(S.TRIP_ID, S.HOUR, S.DOW, S.BUCKET)


def q_weekday_numbering(spark, sf_dir):
    c = _ev(spark, sf_dir).clean
    ref = day_of_week("pickup_datetime", "reference")
    return c.select(S.TRIP_ID, S.DOW, ref.alias("day_of_week_reference"),
                    weekday_label(S.DOW).alias("weekday_label"),
                    weekday_label(ref).alias("weekday_label_reference"))


def q_trip_speed_kmh(spark, sf_dir):
    return present(_ev(spark, sf_dir).clean.select(S.TRIP_ID, speed_kmh(S.DISTANCE, S.DURATION).alias("speed_kmh")))


def q_temporal_split(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    return split_labels(ev.clean, ev.split_us).select(S.TRIP_ID, "split")


def q_dataset_summary(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    return dataset_summary(ev.clean, ev.split_us)


def q_model_input(spark, sf_dir):
    return present(model_input(_ev(spark, sf_dir).training).select(
        S.TRIP_ID, S.DURATION, S.DISTANCE, S.HOUR, S.DOW, S.BUCKET))


def q_median_speeds(spark, sf_dir):
    return present(_ev(spark, sf_dir).median_speeds)


def q_global_speed_fallback(spark, sf_dir):
    g = _ev(spark, sf_dir).global_speed
    return present(spark.range(1).select(F.lit(g).cast("double").alias("global_median_speed_kmh")))


def q_median_speed_eta(spark, sf_dir):
    return present(_ev(spark, sf_dir).with_eta.select(S.TRIP_ID, "estimated_speed_kmh", S.ESTIMATE))


def q_eta_errors(spark, sf_dir):
    return present(_ev(spark, sf_dir).errors.select(
        S.TRIP_ID, S.DURATION, S.ESTIMATE, "error_sec", "abs_error_sec", "pct_error", "abs_pct_error"))


def _metric_table(name):
    def q(spark, sf_dir):
        return present(metrics_tables(_ev(spark, sf_dir).metrics)[name].select(*S.METRIC_COLUMNS))
    q.__name__ = f"q_{name}"
    return q


def q_write_metrics_csv(spark, sf_dir):
    """Metric tables through the CSV sink and back (explicit schema)."""
    tables = metrics_tables(_ev(spark, sf_dir).metrics)
    base = stage_path(spark, "metrics_csv")
    paths = write_metrics_csv(tables, base)
    schema = ("segment_type string, segment_value string, trip_count long, mae_sec double, medae_sec double, "
              "p90_abs_error_sec double, mae_pct double, medae_pct double, p90_abs_error_pct double, "
              "pct_within_10pct double, pct_within_20pct double")
    back = spark.read.option("header", True).schema(schema).csv(paths["metrics_combined"])
    return present(back)


def q_error_by_distance(spark, sf_dir):
    return present(error_by_segment(_ev(spark, sf_dir).metrics, "distance_bucket"))


def q_error_by_hour(spark, sf_dir):
    return present(error_by_segment(_ev(spark, sf_dir).metrics, "hour_of_day"))


def q_error_histogram(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    return present(error_histograms(ev.errors, qtable=ev.error_quantiles))


def q_histogram_markers(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    return present(histogram_markers(ev.errors, qtable=ev.error_quantiles))


def q_calibration_bins(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    return present(calibration_bins(ev.errors, qtable=ev.error_quantiles))


def q_overall_insight(spark, sf_dir):
    return present(overall_insight(_ev(spark, sf_dir).metrics))


def q_best_worst_segment(spark, sf_dir):
    m = _ev(spark, sf_dir).metrics
    return present(best_worst_segment(m, "distance_bucket").unionByName(best_worst_segment(m, "hour_of_day")))


def q_bias_detection(spark, sf_dir):
    return present(bias_detection(_ev(spark, sf_dir).errors))


def _prediction_table(spark, sf_dir) -> DataFrame:
    """Median-speed estimates written as a keyed prediction table."""
    ev = _ev(spark, sf_dir)
    path = stage_path(spark, "trip_predictions")
    write_predictions(ev.with_eta.select(S.TRIP_ID, S.ESTIMATE), path)
    return spark.read.parquet(path)


def q_predictions_join(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    errs = eta_errors(predictions_join(ev.evaluation, _prediction_table(spark, sf_dir)))
    return present(errs.select(S.TRIP_ID, S.DURATION, S.ESTIMATE, "abs_error_sec"))


def q_dedupe_predictions(spark, sf_dir):
    """Two prediction versions per trip (global-speed, then segment-speed); the latest wins."""
    ev = _ev(spark, sf_dir)
    g = ev.global_speed
    v1 = ev.evaluation.select(S.TRIP_ID, F.lit(1).alias("version"),
                              (F.col(S.DISTANCE) / F.nullif(F.lit(g) / F.lit(3600.0), F.lit(0.0))).alias(S.ESTIMATE))
    v2 = ev.with_eta.select(S.TRIP_ID, F.lit(2).alias("version"), S.ESTIMATE)
    return present(dedupe_predictions(v1.unionByName(v2), "version").select(S.TRIP_ID, "version", S.ESTIMATE))


def q_clamp_prediction(spark, sf_dir):
    raw = F.col(S.ESTIMATE) - F.lit(300.0)
    return present(_ev(spark, sf_dir).with_eta.select(
        S.TRIP_ID, raw.alias("raw_prediction"), clamp_prediction(raw).alias(S.ESTIMATE)))


def q_join_fanout_audit(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    minute = lambda df: df.withColumn("_m", F.date_trunc("minute", F.col("pickup_datetime")))
    orders = spark.read.parquet(table_path(sf_dir, "orders"))
    lineitem = spark.read.parquet(table_path(sf_dir, "lineitem"))
    a = fanout_audit(ev.evaluation, ev.with_eta, [S.TRIP_ID], label="trip_id")
    b = fanout_audit(minute(ev.evaluation), minute(ev.with_eta), ["_m"], label="pickup_minute")
    c = fanout_audit(orders, lineitem, ["o_orderkey"], ["l_orderkey"], label="o_orderkey")
    out = a.unionByName(b).unionByName(c)
    return present(out.withColumns({c: F.col(c).cast("long") for c in ("join_rows", "max_key_rows")}))


def q_trip_features(spark, sf_dir):
    return present(trip_features(_ev(spark, sf_dir).clean))


def q_scaler_fit(spark, sf_dir):
    return present(scaler_fit(trip_features(_ev(spark, sf_dir).training)))


def q_standardize(spark, sf_dir):
    feats = trip_features(_ev(spark, sf_dir).training, keep=(S.TRIP_ID,))
    return present(standardize(feats, scaler_fit(feats)))


def q_temporal_validation_split(spark, sf_dir):
    return temporal_validation_split(model_input(_ev(spark, sf_dir).training)).select(S.TRIP_ID, "is_val")


def q_sample_trips(spark, sf_dir):
    clean = _ev(spark, sf_dir).clean
    h = (F.col(S.TRIP_ID) * F.lit(2654435761)) % F.lit(1000003)
    sample = sample_trips(clean, 1000, hashed=h, span=(0, 1000002))
    return present(sample.select(S.TRIP_ID, S.DURATION, S.DISTANCE))


def q_sample_trips_xxhash(spark, sf_dir):
    return present(sample_trips(_ev(spark, sf_dir).clean, 1000).select(S.TRIP_ID, S.DURATION, S.DISTANCE))


def q_append_load(spark, sf_dir):
    """Even events loaded, odd ones appended: ids go on densely, the split is that of all trips."""
    raw = _ev(spark, sf_dir).raw
    target = stage_path(spark, "appended_trips")
    for odd, mode in ((0, "replace"), (1, "append")):
        part = materialize(raw.where(F.col("event_id") % 2 == odd), "half_of_trips")
        load_trips(TripEvaluation(spark, part, tiebreak=("event_id",)), target, mode)
    ev = TripEvaluation.from_clean(spark, spark.read.parquet(target))
    return split_labels(ev.clean, ev.split_us).select("event_id", S.TRIP_ID, "split")


def _clean_rows(spark, sf_dir) -> DataFrame:
    return _ev(spark, sf_dir).clean.drop(S.TRIP_ID)


def q_replace_interrupted(spark, sf_dir):
    """A replace that fails on some rows, and one that another writer outruns, leave the table with its old rows."""
    rows = _clean_rows(spark, sf_dir)
    table = TripTable(spark, stage_path(spark, "replaced_trips"), tiebreak=("event_id",))
    even = table.replace(rows.where("event_id % 2 = 0"), "even")
    broken = rows.withColumn(S.BUCKET, F.when(F.col("event_id") % 100 == 99, F.raise_error(F.lit("the source is gone"))).otherwise(F.col(S.BUCKET)))
    late = TripTable(spark, table.path, tiebreak=("event_id",))
    late.snapshot = lambda version=None: {"version": 0, "loads": []}  # as it was before the even trips came
    for attempt in (lambda: table.replace(broken, "all"), lambda: late.replace(rows, "all")):
        try:
            attempt()
        except Exception as error:  # noqa: BLE001 - both must fail
            if not ("the source is gone" in str(error) or isinstance(error, FileExistsError)):
                raise
        else:
            raise AssertionError("the replace should have failed")
    if table.snapshot() != even:
        raise AssertionError("a failed replace changed the table")
    return table.read().select("event_id", S.TRIP_ID)


def q_append_replayed(spark, sf_dir):
    """Two loads, each repeated: appends to a table that isn't there, then appends that must change nothing."""
    rows = _clean_rows(spark, sf_dir)
    table = TripTable(spark, stage_path(spark, "replayed_trips"), tiebreak=("event_id",))
    for name in ("even", "odd", "odd", "even"):
        table.append(rows.where(F.col("event_id") % 2 == int(name == "odd")), name)
    ev = TripEvaluation.from_clean(spark, table.read())
    return split_labels(ev.clean, ev.split_us).select("event_id", S.TRIP_ID, "split")


def q_append_in_pickup_order(spark, sf_dir):
    """Loads that interleave in time, a later one, and one that is corrected afterwards: ids are places in pickup order."""
    rows = _clean_rows(spark, sf_dir)
    late, third = F.col("pickup_datetime") >= F.expr("TIMESTAMP_NTZ'2024-01-21'"), F.col("event_id") % 3
    table = TripTable(spark, stage_path(spark, "ordered_trips"), tiebreak=("event_id",))
    table.append(rows.where(~late & (third == 0)), "a")
    table.append(rows.where(~late & (third == 1) & (F.col("event_id") % 2 == 0)), "b")
    table.append(rows.where(late), "late")
    table.append(rows.where(~late & (third == 2)), "c")
    table.append(rows.where(~late & (third == 1)), "b")
    return present(table.read().select(*CLEAN_COLS))


def q_metrics_after_append(spark, sf_dir):
    """Metrics over two loads of error rows: the first one's stored sketches and the second one's are merged, no row is sketched twice."""
    errors = _ev(spark, sf_dir).errors
    loads = [materialize(errors.where(F.col(S.TRIP_ID) % 2 == k), "error_load") for k in (0, 1)]
    stored = [materialize(error_sketches(load), "error_sketches") for load in loads]
    q = error_quantiles(loads[0].unionByName(loads[1]), sketches=merged_error_sketches(stored))
    return present(segment_metrics(errors, qtable=materialize(q, "error_quantiles")).select(*S.METRIC_COLUMNS))


def q_verify_content(spark, sf_dir):
    """The content sum of the clean trips as written, and of copies in which two trips swapped a value, one is doubled for another, or nothing changed."""
    rows = _ev(spark, sf_dir).clean.select(*CLEAN_COLS)
    top = F.col(S.TRIP_ID) <= 2
    swapped = rows.withColumn(S.TRIP_ID, F.when(top, 3 - F.col(S.TRIP_ID)).otherwise(F.col(S.TRIP_ID)))
    doubled = rows.where(F.col(S.TRIP_ID) != 1).unionByName(rows.where(F.col(S.TRIP_ID) == 2))
    told = rows.agg(*observed_content(rows)).first()
    found = []
    for name, copy in (("same", rows.repartition(3)), ("swapped", swapped), ("doubled", doubled)):
        try:
            verify_content(materialize(copy, f"content_{name}"), told["rows"], int(told["content"]))
            found.append((name, told["rows"], True))
        except AssertionError:
            found.append((name, told["rows"], False))
    return spark.createDataFrame(found, "copy string, n_rows long, accepted boolean")


def q_write_batched(spark, sf_dir):
    """The clean trips through the batched writer, in two loads with a failed one between them, and back."""
    rows = _ev(spark, sf_dir).clean.select(*CLEAN_COLS)
    path = stage_path(spark, "trip_batches")
    broken = rows.withColumn(S.BUCKET, F.when(F.col("event_id") % 100 == 99, F.raise_error(F.lit("the source is gone"))).otherwise(F.col(S.BUCKET)))
    write_batched(rows.where("event_id % 2 = 0"), path, batchsize=1000)
    try:
        write_batched(broken, path, rows=400_000)
    except Exception as error:  # noqa: BLE001 - it must fail
        if "the source is gone" not in str(error):
            raise
    else:
        raise AssertionError("the write should have failed")
    write_batched(rows.where("event_id % 2 = 1"), path)
    return present(read_batched(spark, path).select(*CLEAN_COLS))


def q_predictions_join_bucketed(spark, sf_dir):
    """Evaluation trips and predictions stored in buckets of trip_id and joined without an exchange."""
    ev = _ev(spark, sf_dir)
    stamp = uuid.uuid4().hex
    names = [f"tripgauge_{kind}_{stamp}" for kind in ("trips", "predictions")]
    for name, rows in zip(names, (ev.evaluation, _prediction_table(spark, sf_dir))):
        write_bucketed(rows, name, 8, path=stage_path(spark, name))
    errs = eta_errors(bucketed_predictions_join(spark, *names))
    return present(errs.select(S.TRIP_ID, S.DURATION, S.ESTIMATE, "abs_error_sec"))


def q_join_worst_keys(spark, sf_dir):
    """The ten keys with the largest fan-out, of three joins."""
    ev = _ev(spark, sf_dir)
    minute = lambda df: df.select(epoch_micros(F.date_trunc("minute", F.col("pickup_datetime")).cast("timestamp_ntz")).alias("k"))
    orders, lineitem, events = (spark.read.parquet(table_path(sf_dir, t)) for t in ("orders", "lineitem", "events"))
    joins = {"pickup_minute": (minute(ev.evaluation), minute(ev.with_eta), ["k"], ["k"]), "o_orderkey": (orders, lineitem, ["o_orderkey"], ["l_orderkey"]),
             "user_id": (events, events, ["user_id"], ["user_id"])}
    out = None
    for name, (a, b, left, right) in joins.items():
        part = worst_keys(a, b, left, right).select(F.lit(name).alias("audit"), F.col(left[0]).cast("long").alias("key"), "left_rows", "right_rows",
                                                    F.col("join_rows").cast("long").alias("join_rows"), "place")
        out = part if out is None else out.unionByName(part)
    return out


def q_scan_trips_csv_mixed(spark, sf_dir):
    """CSV files with four headers (other orders, other spellings, a column of their own), small and large, without a schema."""
    from tripgauge.operators.columns import normalize_columns, parse_timestamps, require_columns

    raw = _ev(spark, sf_dir).raw
    spelt = [
        {c: c for c in raw.columns},
        {"tpep_dropoff_datetime": "dropoff_time", "tpep_pickup_datetime": "pickup_time", "start_lon": "pickup_lon", "start_lat": "pickup_lat",
         "end_lon": "dropoff_lon", "end_lat": "dropoff_lat", "trip_distance": "distance", "event_id": "event_id"},
        {"event_id": "event_id", "trip_distance": "trip_distance_miles", "end_lat": "dropoff_latitude", "end_lon": "dropoff_longitude",
         "start_lat": "pickup_latitude", "start_lon": "pickup_longitude", "tpep_pickup_datetime": "lpep_pickup_datetime", "tpep_dropoff_datetime": "lpep_dropoff_datetime"},
        {"start_lon": "start_lon", "start_lat": "start_lat", "tpep_pickup_datetime": "trip_pickup_datetime", "event_id": "event_id",
         "tpep_dropoff_datetime": "trip_dropoff_datetime", "trip_distance": "distance_miles", "end_lon": "end_lon", "end_lat": "end_lat"}]
    base = stage_path(spark, "mixed_csv")
    for k, names in enumerate(spelt):
        part = raw.where(F.col("event_id") % len(spelt) == k).select(*[F.col(a).alias(b) for a, b in names.items()])
        if k == 3:
            part = part.withColumn("vendor", F.lit("a \"quoted\", name"))
        part.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(f"{base}/part{k}")
    back = parse_timestamps(require_columns(normalize_columns(read_trips(spark, f"{base}/*", "csv"))))
    return present(back.select(F.col("event_id").cast("long").alias("event_id"), *NORM_COLS[1:]))


def q_model_input_evaluation(spark, sf_dir):
    return present(model_input(_ev(spark, sf_dir).evaluation).select(
        S.TRIP_ID, S.DURATION, S.DISTANCE, S.HOUR, S.DOW, S.BUCKET))


def q_bbox_filter(spark, sf_dir):
    return reject_reason(_ev(spark, sf_dir).measured, quality_rules(bbox=True)).select("event_id", "reject_reason")


def q_fill_derived_partial(spark, sf_dir):
    """A third of the rows lacks one column, another third has a wrong old value that must stay."""
    third = F.col(S.TRIP_ID) % 3
    clean = _ev(spark, sf_dir).clean
    clean = clean.withColumns({S.HOUR: F.when(third == 1, F.lit(99)).otherwise(F.col(S.HOUR)),
                               S.BUCKET: F.when(third == 0, F.lit(None)).otherwise(F.col(S.BUCKET))})
    return fill_derived(clean).select(S.TRIP_ID, S.HOUR, S.DOW, S.BUCKET)


def q_write_predictions(spark, sf_dir):
    """Three versions per key through the keyed sink; the latest is stored."""
    eta = _ev(spark, sf_dir).with_eta.select(S.TRIP_ID, S.ESTIMATE)
    versions = eta.withColumn("version", F.explode(F.array(*(F.lit(v) for v in range(3))))).withColumn(S.ESTIMATE, F.col(S.ESTIMATE) + F.col("version"))
    path = stage_path(spark, "versioned_predictions")
    write_predictions(versions, path, order_col="version")
    return present(spark.read.parquet(path))


def q_metrics_order(spark, sf_dir):
    """The order in which the published tables list their segments, as a rank."""
    rows = metrics_tables(_ev(spark, sf_dir).metrics)["metrics_combined"].select("segment_type", "segment_value")
    return row_numbers(rows.select("*", F.monotonically_increasing_id().alias("_at")), ["_at"], "place").drop("_at")


def q_metrics_csv_tables(spark, sf_dir):
    """All five metric tables through the CSV sink and back."""
    out = None
    for name, path in write_metrics_csv(metrics_tables(_ev(spark, sf_dir).metrics), stage_path(spark, "metric_tables_csv")).items():
        back = spark.read.option("header", True).csv(path)
        part = back.select(F.lit(name).alias("table_name"), "segment_type", "segment_value", F.col("trip_count").cast("long").alias("trip_count"),
                           F.col("medae_sec").cast("double").alias("medae_sec"))
        out = part if out is None else out.unionByName(part)
    return present(out)


def q_views_sql(spark, sf_dir):
    _ev(spark, sf_dir).register_views()
    return present(spark.sql("SELECT hour_of_day, count(*) AS trips, avg(abs_error_sec) AS mae_sec FROM eta_errors GROUP BY hour_of_day"))


def q_segment_metrics_custom(spark, sf_dir):
    """Segmentations of the caller's own, with many values and with nulls."""
    segments = [("residue", F.col(S.TRIP_ID) % 701), ("long", F.when(F.col(S.DURATION) > 600, "yes"))]
    out = segment_metrics(_ev(spark, sf_dir).errors, segments)
    return present(out.select("segment_type", "segment_value", "trip_count", "mae_sec", "medae_sec", "p90_abs_error_pct"))


def q_model_facts(spark, sf_dir):
    """The model as one row: rows scored, floor kept, better than the training median, equal after save and load."""
    ev, model = _ev(spark, sf_dir), _model(spark, sf_dir)
    path = stage_path(spark, "duration_model")
    save_model(model, path)
    rows = model_input(ev.evaluation)
    a = predict_duration(model, rows).select(S.TRIP_ID, F.col(S.ESTIMATE).alias("a"))
    b = predict_duration(load_model(path), rows).select(S.TRIP_ID, F.col(S.ESTIMATE).alias("b"))
    middle = exact_percentiles(ev.training, S.DURATION, [0.5], names=["m"]).first()["m"]
    actual = rows.select(S.TRIP_ID, F.col(S.DURATION).alias("y"))
    return a.join(b, S.TRIP_ID).join(actual, S.TRIP_ID).agg(
        F.count(F.lit(1)).alias("n_rows"), (F.min("a") >= 30).alias("at_least_30_sec"),
        (F.avg(F.abs(F.col("a") - F.col("y"))) < F.avg(F.abs(F.lit(middle) - F.col("y")))).alias("beats_training_median"),
        F.bool_and(F.col("a") == F.col("b")).alias("reload_equal"))


def q_model_vs_baseline(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    out = compare_methods({"model": ev.model_errors(_model(spark, sf_dir)), "median_speed": ev.errors})
    return present(out.select("method", *S.METRIC_COLUMNS))


def q_model_vs_baseline_speed(spark, sf_dir):
    """The baseline's half of the comparison with the model, over the same trips."""
    return q_model_vs_baseline(spark, sf_dir).where("method = 'median_speed'")


def q_first_n(spark, sf_dir):
    """The first 5,000 events as read."""
    return first_n(spark.read.parquet(table_path(sf_dir, "events")), 5000).select("event_id", "event_type")


_MODELS: dict = {}


def _model(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    key = id(ev)
    if key not in _MODELS:
        _MODELS[key] = train_duration_model(temporal_validation_split(model_input(ev.training)))
    return _MODELS[key]


def q_predict_duration(spark, sf_dir):
    return present(predict_duration(_model(spark, sf_dir), model_input(_ev(spark, sf_dir).evaluation)))


def q_model_metrics_combined(spark, sf_dir):
    ev = _ev(spark, sf_dir)
    return present(segment_metrics(ev.model_errors(_model(spark, sf_dir))).select(*S.METRIC_COLUMNS))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "normalize_columns": q_normalize_columns,
        "scan_trips_csv": q_scan_trips_csv,
        "trip_duration": q_trip_duration,
        "haversine_km": q_haversine_km,
        "reject_reason": q_reject_reason,
        "filter_stats": q_filter_stats,
        "retention_summary": q_retention_summary,
        "trips_clean": q_trips_clean,
        "write_trips_table": q_write_trips_table,
        "fill_derived": q_fill_derived,
        "weekday_numbering": q_weekday_numbering,
        "trip_speed_kmh": q_trip_speed_kmh,
        "temporal_split": q_temporal_split,
        "dataset_summary": q_dataset_summary,
        "model_input": q_model_input,
        "median_speeds": q_median_speeds,
        "global_speed_fallback": q_global_speed_fallback,
        "median_speed_eta": q_median_speed_eta,
        "eta_errors": q_eta_errors,
        "metrics_combined": _metric_table("metrics_combined"),
        "write_metrics_csv": q_write_metrics_csv,
        "metrics_overall": _metric_table("metrics_overall"),
        "metrics_by_distance": _metric_table("metrics_by_distance"),
        "metrics_by_hour": _metric_table("metrics_by_hour"),
        "metrics_by_day_of_week": _metric_table("metrics_by_day_of_week"),
        "error_by_distance": q_error_by_distance,
        "error_by_hour": q_error_by_hour,
        "error_histogram": q_error_histogram,
        "histogram_markers": q_histogram_markers,
        "calibration_bins": q_calibration_bins,
        "overall_insight": q_overall_insight,
        "best_worst_segment": q_best_worst_segment,
        "bias_detection": q_bias_detection,
        "predictions_join": q_predictions_join,
        "dedupe_predictions": q_dedupe_predictions,
        "clamp_prediction": q_clamp_prediction,
        "join_fanout_audit": q_join_fanout_audit,
        "trip_features": q_trip_features,
        "scaler_fit": q_scaler_fit,
        "standardize": q_standardize,
        "temporal_validation_split": q_temporal_validation_split,
        "sample_trips": q_sample_trips,
        "append_load": q_append_load,
        "replace_interrupted": q_replace_interrupted,
        "append_replayed": q_append_replayed,
        "append_in_pickup_order": q_append_in_pickup_order,
        "metrics_after_append": q_metrics_after_append,
        "verify_content": q_verify_content,
        "write_batched": q_write_batched,
        "first_n": q_first_n,
        "model_vs_baseline_speed": q_model_vs_baseline_speed,
        "predictions_join_bucketed": q_predictions_join_bucketed,
        "join_worst_keys": q_join_worst_keys,
        "scan_trips_csv_mixed": q_scan_trips_csv_mixed,
        "model_input_evaluation": q_model_input_evaluation,
        "bbox_filter": q_bbox_filter,
        "fill_derived_partial": q_fill_derived_partial,
        "write_predictions": q_write_predictions,
        "metrics_order": q_metrics_order,
        "metrics_csv_tables": q_metrics_csv_tables,
        "views_sql": q_views_sql,
        "segment_metrics_custom": q_segment_metrics_custom,
        "model_facts": q_model_facts,
        "stream_clean_trips": q_stream_clean_trips,
        "stream_reject_counts": q_stream_reject_counts,
        # Rows-only: no SQL oracle (seeded xxhash64 order, model training/scoring).
        "sample_trips_xxhash": q_sample_trips_xxhash,
        "predict_duration": q_predict_duration,
        "model_metrics_combined": q_model_metrics_combined,
        "model_vs_baseline": q_model_vs_baseline,
    }
    return q
