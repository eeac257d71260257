"""Sink round trips, fan-out audit, prediction dedupe and model persistence."""

import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tripgauge.operators.audit import fanout_audit
from tripgauge.operators.estimate import dedupe_predictions
from tripgauge.plans.evaluation import evaluation_for
from tripgauge.sources.readers import read_trips
from tripgauge.sources.sinks import verify_row_count, write_metrics_csv, write_trips_table


@pytest.fixture(scope="module")
def ev(spark):
    return evaluation_for(spark, SF001)


def test_table_modes(spark, ev):
    d = tempfile.mkdtemp(prefix="tg-sink-")
    df = ev.clean.select("trip_id", "trip_duration_sec")
    n = write_trips_table(df, f"{d}/t", "replace")
    assert verify_row_count(spark.read.parquet(f"{d}/t"), n) == n
    write_trips_table(df, f"{d}/t", "append")
    assert spark.read.parquet(f"{d}/t").count() == 2 * n
    write_trips_table(df, f"{d}/t", "replace")
    assert spark.read.parquet(f"{d}/t").count() == n
    with pytest.raises(Exception):
        write_trips_table(df, f"{d}/t", "fail")


def test_csv_round_trip(spark, ev):
    d = tempfile.mkdtemp(prefix="tg-csv-")
    paths = write_metrics_csv(ev.tables(), d)
    assert set(paths) == {"metrics_overall", "metrics_by_distance", "metrics_by_hour",
                          "metrics_by_day_of_week", "metrics_combined"}
    back = read_trips(spark, paths["metrics_combined"], "csv")  # inferred schema
    assert back.count() == ev.metrics.count()


def test_fanout_audit_counts(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    right = spark.createDataFrame([(1,), (1,), (1,), (3,)], "k long")
    r = fanout_audit(left, right, ["k"]).first()
    assert (r["left_rows"], r["right_rows"], r["join_rows"], r["max_key_rows"]) == (3, 4, 6, 6)
    assert (r["left_dup_keys"], r["right_dup_keys"], r["matched_keys"], r["keys_unique"]) == (1, 1, 1, False)
    assert r["join_rows"] == left.join(right, "k").count()


def test_dedupe_keeps_latest(spark):
    df = spark.createDataFrame([(1, 1, 10.0), (1, 3, 30.0), (1, 2, 20.0), (2, 1, 5.0)],
                               "trip_id long, version int, estimated_duration_sec double")
    got = {r["trip_id"]: r["estimated_duration_sec"] for r in dedupe_predictions(df, "version").collect()}
    assert got == {1: 30.0, 2: 5.0}


def test_model_save_load_identical(spark, ev):
    from tripgauge.operators.model import load_model, predict_duration, save_model, train_duration_model
    from tripgauge.operators.split import model_input, temporal_validation_split

    train = temporal_validation_split(model_input(ev.training))
    model = train_duration_model(train, max_iter=5, median_trees=1)
    d = tempfile.mkdtemp(prefix="tg-model-")
    save_model(model, f"{d}/m")
    a = predict_duration(model, model_input(ev.evaluation)).orderBy("trip_id").collect()
    b = predict_duration(load_model(f"{d}/m"), model_input(ev.evaluation)).orderBy("trip_id").collect()
    assert a == b and all(r["estimated_duration_sec"] >= 30.0 for r in a)


def test_jdbc_writer_sizing():
    from tripgauge.sources.sinks import jdbc_writers

    assert [jdbc_writers(n) for n in (0, 99_999, 100_000, 450_000, 10**9)] == [1, 1, 1, 4, 200]


def test_views_accept_plain_sql(spark, ev):
    names = ev.register_views()
    assert {"trips_clean", "eta_errors", "metrics_combined", "metrics_by_hour"} <= set(names)
    joined = spark.sql("""
        select e.n, m.trip_count, e.middle - m.medae_sec as gap
        from (select count(abs_error_sec) n, median(abs_error_sec) middle from eta_errors) e, metrics_overall m""").first()
    assert joined["n"] == joined["trip_count"] and abs(joined["gap"]) < 1e-9
    hours = spark.sql("SELECT hour_of_day::STRING AS h, COUNT(*) AS n FROM eta_errors GROUP BY 1").count()
    assert hours == spark.sql("SELECT COUNT(*) FROM metrics_by_hour").first()[0]


def test_in_plan_scoring_equals_join(spark, ev):
    from tripgauge.operators.errors import eta_errors
    from tripgauge.operators.model import predict_duration, score_rows, train_duration_model
    from tripgauge.operators.split import model_input, model_rows, temporal_validation_split

    model = train_duration_model(temporal_validation_split(model_input(ev.training)), max_iter=3, median_trees=1)
    a = score_rows(model, model_rows(ev.evaluation))
    assert a.columns[:-1] == ev.evaluation.columns and dict(a.dtypes)["hour_of_day"] == "int"
    joined = eta_errors(ev.evaluation.join(predict_duration(model, model_input(ev.evaluation)), "trip_id"))
    left = sorted((r["trip_id"], r["estimated_duration_sec"]) for r in eta_errors(a).collect())
    right = sorted((r["trip_id"], r["estimated_duration_sec"]) for r in joined.collect())
    assert left == right


def test_prediction_keys_are_enforced(spark):
    from tripgauge.sources.sinks import write_predictions

    d = tempfile.mkdtemp(prefix="tg-keys-")
    preds = spark.createDataFrame([(1, 10.0, 1), (1, 20.0, 2), (2, 30.0, 1)], "trip_id long, estimated_duration_sec double, version int")
    with pytest.raises(ValueError, match="2 predictions"):
        write_predictions(preds, f"{d}/p")
    assert write_predictions(preds, f"{d}/p", order_col="version") == 2
    assert sorted(tuple(r) for r in spark.read.parquet(f"{d}/p").collect()) == [(1, 20.0), (2, 30.0)]


def test_fanout_of_huge_keys_does_not_overflow(spark, monkeypatch):
    from tripgauge.operators import audit

    rows = spark.createDataFrame([(1,)], "k int")
    big = 4_000_000_000
    monkeypatch.setattr(audit.F, "count", lambda c, count=audit.F.count: F.lit(big) * F.max(F.lit(1)) if str(c) == str(F.lit(1)) else count(c))
    out = audit.fanout_audit(rows, rows, ["k"]).first()
    assert out["join_rows"] == big * big


def test_median_trees_lower_the_absolute_error(spark):
    """Skewed errors: the mean of a leaf is far from its median, and the trees for absolute loss find it; a saved model agrees."""
    from pyspark.sql import functions as F

    from tripgauge.operators.model import count_trees, load_model, model_mae, save_model, train_duration_model

    rows = spark.range(4000).select(
        F.col("id").alias("trip_id"), ((F.col("id") * 7919) % 100 / 10.0 + 0.2).alias("haversine_distance_km"), (F.col("id") % 24).cast("int").alias("hour_of_day"),
        (F.col("id") % 7).cast("int").alias("day_of_week"), F.lit("1-3mi").alias("distance_bucket"), F.lit(40.7).alias("pickup_latitude"), F.lit(-74.0).alias("pickup_longitude"),
        F.lit(40.8).alias("dropoff_latitude"), F.lit(-73.9).alias("dropoff_longitude"), (F.col("id") >= 3500).alias("is_val"))
    late = F.when(F.xxhash64("trip_id") % 5 == 0, 3000).otherwise(0)
    rows = rows.withColumn("trip_duration_sec", (F.col("haversine_distance_km") * 100 + late).cast("long"))
    plain, median = (train_duration_model(rows, max_iter=3, max_depth=4, median_trees=n) for n in (0, 3))
    a, b = model_mae(plain, rows), model_mae(median, rows)
    assert b < 0.9 * a and count_trees(plain) < count_trees(median) <= count_trees(plain) + 3
    d = tempfile.mkdtemp(prefix="tg-median-")
    save_model(median, f"{d}/m")
    assert model_mae(load_model(f"{d}/m"), rows) == b


def test_training_rows_are_dealt_to_tasks_of_bounded_size(spark, monkeypatch):
    """All rows in one partition: every tree is fitted on rows dealt evenly, and the model is the same as without."""
    from tripgauge.operators import model as m

    rows = spark.range(0, 4000, 1, 1).select(
        F.lit(7).cast("long").alias("trip_id"), ((F.col("id") * 7919) % 100 / 10.0 + 0.2).alias("haversine_distance_km"), (F.col("id") % 24).cast("int").alias("hour_of_day"),
        (F.col("id") % 7).cast("int").alias("day_of_week"), F.lit("1-3mi").alias("distance_bucket"), F.lit(40.7).alias("pickup_latitude"), F.lit(-74.0).alias("pickup_longitude"),
        F.lit(40.8).alias("dropoff_latitude"), F.lit(-73.9).alias("dropoff_longitude"), (F.col("id") >= 3500).alias("is_val"),
        ((F.col("id") * 31) % 997 + 60).alias("trip_duration_sec"))
    a = m.model_mae(m.train_duration_model(rows, max_iter=2, max_depth=3, median_trees=1), rows)
    sizes = []
    for kind in (m.Pipeline, m.DecisionTreeRegressor):
        fit = kind.fit
        monkeypatch.setattr(kind, "fit", lambda self, data, fit=fit: (sizes.append(data.rdd.glom().map(len).collect()), fit(self, data))[1])
    monkeypatch.setattr(m, "ROWS_PER_TASK", 500, raising=False)
    b = m.model_mae(m.train_duration_model(rows, max_iter=2, max_depth=3, median_trees=1), rows)
    assert len(sizes) == 2 and all(max(s) <= 510 for s in sizes) and sum(sizes[0]) == 4000
    assert b == pytest.approx(a, rel=1e-6)
