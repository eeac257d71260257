"""The versioned trip table: numbering over loads, replays, corrections, failures, files."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripgauge.sources import files, triptable
from tripgauge.sources.sinks import content_hash, observed_content, verify_content, write_trips_table
from tripgauge.sources.triptable import TripTable

SCHEMA = "event_id long, pickup_datetime timestamp_ntz, pickup_latitude double, pickup_longitude double, note string"


def trips(spark, ids, span=200, seed=1):
    """Trips at few different times, places and notes, so that ties abound; ids are unique."""
    rng = random.Random(seed)
    rows = []
    for i in range(max(ids, default=-1) + 1):
        row = (i, rng.randrange(span), rng.randrange(2) / 4, rng.randrange(2) / 4, rng.choice(["x", None]))
        if i in ids:
            rows.append(row)
    frame = spark.createDataFrame(rows, "event_id long, s long, pickup_latitude double, pickup_longitude double, note string")
    at = F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, s)")
    return frame.select("event_id", at.alias("pickup_datetime"), "pickup_latitude", "pickup_longitude", "note")


def in_order(rows):
    got = sorted(rows, key=lambda r: r["trip_id"])
    assert [r["trip_id"] for r in got] == list(range(1, len(got) + 1))
    keys = [(r["pickup_datetime"], r["pickup_latitude"], r["pickup_longitude"], r["event_id"]) for r in got]
    assert keys == sorted(keys)
    return {r["event_id"] for r in got}


@pytest.mark.parametrize("cuts,steps", [(triptable.MAX_CUTS, triptable.MAX_STEPS), (40, triptable.MAX_STEPS), (triptable.MAX_CUTS, 3)])
def test_ids_follow_pickup_order_over_interleaved_loads(spark, tmp_path, monkeypatch, cuts, steps):
    monkeypatch.setattr(triptable, "MAX_CUTS", cuts)
    monkeypatch.setattr(triptable, "MAX_STEPS", steps)
    monkeypatch.setattr(triptable, "BLOCK", 16)
    monkeypatch.setattr(triptable, "SHORT", 10_000 if cuts > 40 and steps > 3 else 5)
    table = TripTable(spark, str(tmp_path / "t"), tiebreak=("event_id",))
    rng, left = random.Random(7), set(range(400))
    for k in range(3):
        some = set(rng.sample(sorted(left), 100))
        left -= some
        table.append(trips(spark, some), f"load {k}")
    assert in_order(table.read().collect()) == set(range(400)) - left
    assert in_order(table.read(2).collect()) < set(range(400)) - left  # an earlier version still reads as it was
    if cuts == 40:
        table.compact("all")
        assert in_order(table.read().collect()) == set(range(400)) - left and len(table.snapshot()["loads"]) == 1


def test_later_rows_read_nothing_of_the_stored_ones(spark, tmp_path):
    table = TripTable(spark, str(tmp_path / "t"), tiebreak=("event_id",))
    table.append(trips(spark, set(range(100))), "a")
    later = trips(spark, set(range(100, 150))).withColumn("pickup_datetime", F.expr("pickup_datetime + INTERVAL '1' DAY"))
    load = table.append(later, "b")["loads"][1]
    assert load["moved"] is None and load["placed"] == [[1, 50, 100]] and in_order(table.read().collect()) == set(range(150))
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange hash" not in plan and "Python" not in plan


def test_replays_and_corrections(spark, tmp_path):
    table = TripTable(spark, str(tmp_path / "t"), tiebreak=("event_id",))
    table.append(trips(spark, set(range(0, 90, 3))), "a")
    table.append(trips(spark, set(range(1, 90, 3))), "b")
    now = table.append(trips(spark, set(range(2, 90, 3))), "c")
    assert table.append(trips(spark, set(range(1, 90, 3))).repartition(3), "b") == now == table.snapshot()
    table.append(trips(spark, set(range(1, 60, 3))), "b")
    assert in_order(table.read().collect()) == set(range(0, 90, 3)) | set(range(1, 60, 3)) | set(range(2, 90, 3))
    assert [load["id"] for load in table.snapshot()["loads"]] == ["a", "b", "c"]
    table.replace(trips(spark, {1, 2}), "new")
    assert in_order(table.read().collect()) == {1, 2}
    assert table.expire(1) and in_order(table.read().collect()) == {1, 2} and len(table.versions()) == 1


def test_failures_leave_the_old_rows(spark, tmp_path, monkeypatch):
    table = TripTable(spark, str(tmp_path / "t"), tiebreak=("event_id",))
    with pytest.raises(ValueError, match="no trips"):
        table.read()
    table.append(trips(spark, {1, 2, 3}), "a")
    held = table.snapshot()
    with monkeypatch.context() as m:  # the rows are written, the job dies before the pointer
        m.setattr(triptable, "write_new", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            table.replace(trips(spark, {7, 8}), "b")
    with monkeypatch.context() as m:  # what was written does not read back
        m.setattr(triptable, "verify_content", lambda rows, n, c: verify_content(rows.limit(1), n, c))
        with pytest.raises(AssertionError):
            table.append(trips(spark, {7, 8}), "b")
    with pytest.raises(ValueError, match="columns"):
        table.append(trips(spark, {7, 8}).drop("note"), "b")
    with pytest.raises(ValueError, match="pickup_datetime"):
        table.append(trips(spark, {7, 8}).withColumn("pickup_datetime", F.lit(None).cast("timestamp_ntz")), "b")
    assert table.snapshot() == held and in_order(table.read().collect()) == {1, 2, 3}
    assert len(table.expire(5)) == 3 and in_order(table.read().collect()) == {1, 2, 3}  # their folders go


def test_empty_and_equal_rows(spark, tmp_path):
    table = TripTable(spark, str(tmp_path / "t"))
    table.append(trips(spark, set()), "nothing")
    assert table.read().count() == 0
    same = trips(spark, {5})
    table.append(same.unionByName(same), "a")
    table.append(same.unionByName(same).unionByName(same), "b")
    table.append(trips(spark, set()), "none")
    assert sorted(r["trip_id"] for r in table.read().collect()) == [1, 2, 3, 4, 5]


def test_a_file_appears_once_and_whole(spark, tmp_path):
    path = str(tmp_path / "d" / "1.json")
    files.write_new(spark, path, "é\n{}")
    with pytest.raises(FileExistsError):
        files.write_new(spark, path, "other")
    assert files.read_text(spark, path) == "é\n{}" and files.list_names(spark, str(tmp_path / "d")) == ["1.json"]
    assert files.list_names(spark, str(tmp_path / "absent")) == []


def test_content_sum_sees_moved_nulls_and_write_verifies(spark, tmp_path, monkeypatch):
    a = spark.createDataFrame([("x", None), (None, "y")], "p string, q string")
    b = spark.createDataFrame([(None, "x"), (None, "y")], "p string, q string")
    told = a.agg(*observed_content(a)).first()
    verify_content(a.repartition(2), told["rows"], int(told["content"]))
    with pytest.raises(AssertionError):
        verify_content(b, told["rows"], int(told["content"]))
    assert a.select(content_hash(a)).distinct().count() == 2
    assert write_trips_table(a, str(tmp_path / "w"), verify=True) == 2
    with pytest.raises(ValueError):
        write_trips_table(a, str(tmp_path / "w"), "append", verify=True)


def test_steps_are_a_function(spark, tmp_path):
    table = TripTable(spark, str(tmp_path / "t"), tiebreak=("event_id",))
    table.append(trips(spark, set(range(0, 300, 2))), "a")
    load = table.append(trips(spark, set(range(1, 300, 2))), "b")["loads"][1]
    for name, n in (("placed", 150), ("moved", 150)):
        ids = np.concatenate([np.arange(lo, hi + 1) for lo, hi, _ in load[name]])
        assert ids.tolist() == list(range(1, n + 1)) and (np.diff([shift for *_, shift in load[name]]) > 0).all()
