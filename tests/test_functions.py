"""Hand-computed unit rows for the column helpers and quality rules."""

import math

from pyspark.sql import functions as F

from tripgauge.functions import day_of_week, distance_bucket, duration_seconds, haversine_km, parse_timestamp, weekday_label
from tripgauge.operators.estimate import clamp_prediction
from tripgauge.operators.quality import quality_rules, reject_reason


def test_haversine_known_values(spark):
    df = spark.createDataFrame([(0.0, 0.0, 90.0, 0.0), (40.7, -74.0, 40.7, -74.0), (None, 0.0, 1.0, 1.0)],
                               "a double, b double, c double, d double")
    out = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert math.isclose(out[0], 6371.0 * math.pi / 2, rel_tol=1e-12)
    assert out[1] == 0.0
    assert out[2] is None


def test_bucket_edges(spark):
    df = spark.createDataFrame([(1.608,), (1.609,), (4.828,), (8.047,), (16.093,), (0.0,)], "km double")
    got = [r[0] for r in df.select(distance_bucket("km")).collect()]
    assert got == ["<1mi", "1-3mi", "3-5mi", "5-10mi", "10+mi", "<1mi"]


def test_weekday_numbering_sunday(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-07 10:00:00' AS ts")
    r = df.select(day_of_week("ts").alias("m"), day_of_week("ts", "reference").alias("r")).first()
    assert (r["m"], r["r"]) == (6, 0)
    lab = df.select(weekday_label(day_of_week("ts")).alias("a"),
                    weekday_label(day_of_week("ts", "reference")).alias("b")).first()
    assert (lab["a"], lab["b"]) == ("Sunday", "Monday")


def test_duration_truncates_each_timestamp(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:10.9' AS a, TIMESTAMP_NTZ'2024-01-01 00:00:41.1' AS b")
    assert df.select(duration_seconds("a", "b")).first()[0] == 31


def test_bad_timestamp_text_is_null(spark):
    df = spark.createDataFrame([("2024-13-99 00:00:00",), ("2024-01-01 00:00:01",), ("2024-01-01 00:00:01.5",)], "s string")
    got = [r[0] for r in df.select(parse_timestamp("s").cast("string")).collect()]
    assert got[0] is None and got[1] == "2024-01-01 00:00:01" and got[2].startswith("2024-01-01 00:00:01.5")


def _trips(spark, rows):
    schema = ("pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, pickup_latitude double, "
              "pickup_longitude double, dropoff_latitude double, dropoff_longitude double, "
              "trip_duration_sec long, haversine_distance_km double")
    return spark.createDataFrame(rows, schema)


def test_rule_edges_and_first_failure(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    ok = (t, t, 40.7, -74.0, 40.71, -74.0)
    rows = [
        (*ok, 30, 1.0), (*ok, 31, 1.0), (*ok, 7200, 1.0), (*ok, 7201, 1.0),         # duration edges
        (*ok, 100, 0.1), (*ok, 100, 100.0), (*ok, 100, float("nan")), (*ok, 100, None),  # distance edges
        (t, t, 90.0, -74.0, 40.7, -74.0, 100, 1.0), (t, t, -90.0, -74.0, 40.7, -74.0, 100, 1.0),
        (t, t, 90.0001, -74.0, 40.7, -74.0, 100, 1.0),
        (None, t, 95.0, -74.0, 40.7, -74.0, None, 1.0),   # bad time and bad coordinates: earlier rule
    ]
    got = [r[0] for r in reject_reason(_trips(spark, rows), quality_rules()).select("reject_reason").collect()]
    assert got == ["invalid_duration", "ok", "ok", "invalid_duration",
                   "ok", "ok", "invalid_distance", "invalid_distance",
                   "ok", "ok", "invalid_coordinate_range", "missing_datetime"]


def test_clamp_prediction(spark):
    df = spark.createDataFrame([(29.9,), (-5.0,), (None,), (45.0,), (float("nan"),)], "p double")
    got = [r[0] for r in df.select(clamp_prediction("p")).collect()]
    assert got[:4] == [30.0, 30.0, None, 45.0] and math.isnan(got[4])


def test_within_threshold_exact_tenth(spark):
    # actual 100, estimate 110 -> relative error 0.1, counted within 10%
    from tripgauge.operators.errors import eta_errors

    df = spark.createDataFrame([(100, 110.0)], "trip_duration_sec long, estimated_duration_sec double")
    e = eta_errors(df).select((F.col("abs_pct_error") <= 0.10).alias("w")).first()
    assert e["w"] is True


def _clean_rows(spark, rows):
    schema = ("trip_id long, hour_of_day int, distance_bucket string, trip_duration_sec long, "
              "haversine_distance_km double")
    return spark.createDataFrame(rows, schema)


def test_segment_fallback_below_ten_trips(spark):
    """A segment with 9 training trips uses the global median; one with 10 its own."""
    from tripgauge.operators.estimate import global_speed, median_speed_eta, median_speeds

    rows = [(i, 8, "1-3mi", 600, 2.0) for i in range(9)]                   # 12 km/h, 9 trips
    rows += [(100 + i, 9, "1-3mi", 360, 2.0) for i in range(10)]           # 20 km/h, 10 trips
    training = _clean_rows(spark, rows)
    speeds = median_speeds(training)
    assert {(r["hour_of_day"], r["trip_count"]) for r in speeds.collect()} == {(9, 10)}
    g = global_speed(training)
    evaluation = _clean_rows(spark, [(1000, 8, "1-3mi", 500, 2.0), (1001, 9, "1-3mi", 500, 2.0)])
    got = {r["trip_id"]: r["estimated_speed_kmh"] for r in median_speed_eta(evaluation, speeds, g).collect()}
    assert got[1001] == 20.0 and got[1000] == g


def test_equal_time_and_point_get_distinct_ids(spark):
    import datetime as dt

    from tripgauge.operators.ids import assign_trip_id

    t = dt.datetime(2024, 1, 1, 8, 0)
    df = spark.createDataFrame([(7, t, 40.7, -74.0), (3, t, 40.7, -74.0), (5, t, 40.6, -74.0)],
                               "event_id long, pickup_datetime timestamp_ntz, pickup_latitude double, "
                               "pickup_longitude double")
    got = {r["event_id"]: r["trip_id"] for r in assign_trip_id(df, tiebreak=["event_id"]).collect()}
    assert got == {5: 1, 3: 2, 7: 3}


def test_time_arithmetic_ignores_session_zone(spark):
    from tripgauge.functions import epoch_micros

    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 01:59:59.250001' AS a, TIMESTAMP_NTZ'2024-03-10 03:00:00.1' AS b "
                   "UNION ALL SELECT TIMESTAMP_NTZ'1969-12-31 23:59:59.5', TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    old = spark.conf.get("spark.sql.session.timeZone")
    got = []
    try:
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got.append([tuple(r) for r in df.select(epoch_micros("a"), epoch_micros("b"),
                                                     duration_seconds("a", "b")).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got[0] == got[1] == got[2]
    assert got[0] == [(1710035999250001, 1710039600100000, 3601), (-500000, 0, 1)]


def test_first_rows_stay_spread(spark, tmp_path):
    from tripgauge.sources.readers import first_n

    path = str(tmp_path / "rows")
    spark.range(0, 1000, 1, 5).write.parquet(path)
    rows = spark.read.parquet(path)
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 40))  # a partition a file
    try:
        order = [r["id"] for r in rows.collect()]
        for n in (0, 1, 199, 200, 201, 650, 1000, 5000):
            some = first_n(rows, n)
            assert [r["id"] for r in some.collect()] == order[:n]
        assert first_n(rows, 650).rdd.getNumPartitions() == rows.rdd.getNumPartitions()
        assert first_n(rows.limit(0), 3).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_stages_are_removed_on_request():
    import subprocess
    import sys
    import tempfile

    code = """
import os, sys
from tripgauge.session import close_stages, local_session, materialize
spark = local_session(1, 1)
spark.sparkContext.setCheckpointDir(sys.argv[1])
base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
os.makedirs(base + "/tripgauge/other")
assert not close_stages(spark)
a, b = materialize(spark.range(3), "a"), materialize(spark.range(4), "b")
assert a.count() + b.count() == 7 and len(os.listdir(base + "/tripgauge")) == 2
assert close_stages(spark) and os.listdir(base + "/tripgauge") == ["other"]
"""
    subprocess.run([sys.executable, "-c", code, tempfile.mkdtemp(prefix="tg-close-")], check=True, cwd=__file__.rsplit("/", 2)[0])
