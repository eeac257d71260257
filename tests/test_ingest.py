"""Ingest from CSV: other column spellings, inferred types, bad timestamps, extra columns."""

import os
import tempfile

import pytest

from tripgauge.operators.columns import derive_measures, normalize_columns, parse_timestamps, require_columns
from tripgauge.operators.quality import filter_stats, reject_reason
from tripgauge.sources.readers import csv_headers, read_trips

CSV = """lpep_pickup_datetime,lpep_dropoff_datetime,pickup_lat,pickup_lon,dropoff_lat,dropoff_lon,distance_miles,vendor
2024-01-07 10:00:00,2024-01-07 10:10:00,40.70,-74.00,40.75,-73.98,3.6,A
2024-01-07 11:00:00.5,2024-01-07 11:00:40.5,40.70,-74.00,40.71,-74.00,0.7,B
2024-13-99 00:00:00,2024-01-07 12:00:00,40.70,-74.00,40.71,-74.00,0.7,C
2024-01-07 13:00:00,2024-01-07 13:20:00,95.0,-74.00,40.71,-74.00,0.7,D
"""


@pytest.fixture()
def csv_path():
    d = tempfile.mkdtemp(prefix="tg-ingest-")
    p = os.path.join(d, "trips.csv")
    with open(p, "w") as fh:
        fh.write(CSV)
    return p


def test_inferred_csv_through_rules(spark, csv_path):
    raw = read_trips(spark, csv_path, "csv")  # inferSchema: mixed text stays string
    df = derive_measures(parse_timestamps(require_columns(normalize_columns(raw))))
    assert "vendor" in df.columns and "trip_distance" in df.columns
    rows = reject_reason(df).orderBy("vendor").select("vendor", "trip_duration_sec", "reject_reason").collect()
    assert [(r["vendor"], r["trip_duration_sec"], r["reject_reason"]) for r in rows] == [
        ("A", 600, "ok"), ("B", 40, "ok"), ("C", None, "missing_datetime"), ("D", 1200, "invalid_coordinate_range")]
    stats = {r["reject_reason"]: r["n"] for r in filter_stats(df).collect()}
    assert stats["ok"] == 2 and sum(stats.values()) == 4


def test_missing_column_message(spark, csv_path):
    raw = read_trips(spark, csv_path, "csv").drop("distance_miles")
    with pytest.raises(ValueError, match="trip_distance"):
        require_columns(normalize_columns(raw))


def test_inferred_timestamp_columns(spark):
    d = tempfile.mkdtemp(prefix="tg-ingest-ts-")
    p = os.path.join(d, "t.csv")
    with open(p, "w") as fh:
        fh.write("pickup_datetime,dropoff_datetime,pickup_latitude,pickup_longitude,dropoff_latitude,"
                 "dropoff_longitude,trip_distance\n2024-01-07 10:00:00,2024-01-07 10:10:00,40.7,-74.0,40.75,-73.98,3.6\n")
    raw = read_trips(spark, p, "csv")
    df = derive_measures(parse_timestamps(require_columns(normalize_columns(raw))))
    r = df.select("pickup_datetime", "trip_duration_sec").first()
    assert dict(df.dtypes)["pickup_datetime"] == "timestamp_ntz" and r["trip_duration_sec"] == 600


MIXED = [("tpep_pickup_datetime,tpep_dropoff_datetime,start_lat,start_lon,end_lat,end_lon,trip_distance,vendor",
          "2024-03-10 02:30:00,2024-03-10 03:10:00,40.7,-74.0,40.75,-73.98,3.6,A"),
         ("dropoff_datetime,pickup_datetime,pickup_lon,pickup_lat,dropoff_lon,dropoff_lat,distance",
          "2024-03-10 03:10:00,2024-03-10 02:30:00,-74.0,40.7,-73.98,40.75,3.6")]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("schema", [None, "distance double, trip_distance double, start_lat double, start_lon double, end_lat double, end_lon double, "
                                          "pickup_lat double, pickup_lon double, dropoff_lat double, dropoff_lon double"])
def test_files_with_other_column_orders_and_zones(spark, zone, schema):
    d = tempfile.mkdtemp(prefix="tg-mixed-")
    for i, (header, row) in enumerate(MIXED):
        with open(os.path.join(d, f"part{i}.csv"), "w") as fh:
            fh.write(f"{header}\n{row}\n")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = derive_measures(parse_timestamps(require_columns(normalize_columns(read_trips(spark, d, "csv", schema)))))
        cols = ["pickup_datetime", "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude", "trip_distance", "trip_duration_sec"]
        rows = df.select(*cols).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert len(rows) == 2 and rows[0] == rows[1]
    assert rows[0]["trip_duration_sec"] == 2400 and rows[0]["pickup_datetime"].hour == 2 and rows[0]["pickup_longitude"] == -74.0


@pytest.mark.parametrize("small", [0, 1 << 20])
def test_headers_of_many_files_take_a_constant_number_of_jobs(spark, small):
    d = tempfile.mkdtemp(prefix="tg headers+%41-")
    shapes = ["a,b", "b,a", '"a, c",b']
    for i in range(90):
        with open(os.path.join(d, f"f {i}+%.csv"), "w") as fh:
            fh.write("\n" * (i % 3 == 1) + shapes[i % 3] + "\n" + "1,2\n" * i)
    open(os.path.join(d, "empty.csv"), "w").close()
    group = spark.sparkContext.statusTracker()
    before = len(group.getJobIdsForGroup(None))
    found = csv_headers(spark, d, small).collect()
    assert len(group.getJobIdsForGroup(None)) - before <= 4
    assert {r["path"].rsplit("/", 1)[1]: r["header"] for r in found} == {f"f {i}+%.csv": shapes[i % 3] for i in range(90)}
    rows = read_trips(spark, d, "csv", "a int, b int, `a, c` int")
    assert rows.columns == ["a", "b", "a, c"] and rows.count() == sum(range(90))
    sums = rows.selectExpr("sum(a)", "sum(b)", "sum(`a, c`)").first()
    n = [sum(range(k, 90, 3)) for k in range(3)]
    assert tuple(sums) == (n[0] + 2 * n[1], 2 * n[0] + n[1] + 2 * n[2], n[2])


def test_folder_without_headers(spark):
    d = tempfile.mkdtemp(prefix="tg-nothing-")
    open(os.path.join(d, "empty.csv"), "w").close()
    assert read_trips(spark, d, "csv", "a int").count() == 0 and read_trips(spark, d, "csv").columns == []
