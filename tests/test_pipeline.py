"""Pipeline invariants, fixture expectations, plan shape and the oracle gate."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from tripgauge.plans.evaluation import evaluation_for


@pytest.fixture(scope="module")
def ev(spark):
    return evaluation_for(spark, SF01)


def test_fixture_expectations(ev):
    assert ev.raw.count() == 10_000
    assert ev.clean.count() == 9_268
    stats = {r["reject_reason"]: r["count"] for r in ev.labelled.groupBy("reject_reason").count().collect()}
    assert stats["invalid_coordinate_range"] == 136 and stats["invalid_distance"] == 140
    assert sum(stats.values()) == 10_000
    assert (ev.training.count(), ev.evaluation.count()) == (6_487, 2_781)
    assert ev.median_speeds.count() == 103
    assert ev.metrics.count() == 37


def test_trip_ids_dense(ev):
    r = ev.clean.agg(F.min("trip_id"), F.max("trip_id"), F.countDistinct("trip_id"), F.count("*")).first()
    assert tuple(r) == (1, 9_268, 9_268, 9_268)


def test_trip_ids_follow_pickup_order(ev):
    rows = ev.clean.select("trip_id", "pickup_datetime", "pickup_latitude", "pickup_longitude", "event_id").collect()
    by_id = sorted(rows, key=lambda r: r["trip_id"])
    keys = [(r["pickup_datetime"], r["pickup_latitude"], r["pickup_longitude"], r["event_id"]) for r in by_id]
    assert keys == sorted(keys)


def test_metric_invariants(ev):
    m = {(r["segment_type"], r["segment_value"]): r for r in ev.metrics.collect()}
    total = m[("overall", "all")]["trip_count"]
    for seg in ("distance_bucket", "hour_of_day", "day_of_week"):
        assert sum(r["trip_count"] for k, r in m.items() if k[0] == seg) == total
    for r in m.values():
        assert r["p90_abs_error_sec"] >= r["medae_sec"]
        assert r["pct_within_20pct"] >= r["pct_within_10pct"]


def test_histogram_and_calibration(ev):
    from tripgauge.operators.charts import calibration_bins, error_histograms

    h = error_histograms(ev.errors).collect()
    n = ev.errors.count()
    for metric in ("abs_error_sec", "abs_pct_error_x100"):
        assert sum(r["n"] for r in h if r["metric"] == metric) == n
    assert sum(1 for r in h if r["metric"] == "abs_error_sec" and r["n"] > 0) == 38
    c = calibration_bins(ev.errors, qtable=ev.error_quantiles).collect()
    assert len(c) == 19


def test_constant_histogram(spark):
    from tripgauge.operators.charts import error_histograms

    df = spark.createDataFrame([(5.0, 0.5)] * 4, "abs_error_sec double, abs_pct_error double")
    rows = error_histograms(df).where("metric = 'abs_error_sec'").collect()
    assert sum(r["n"] for r in rows) == 4 and [r["bin"] for r in rows if r["n"]] == [25]


def test_eta_plan_shape(ev):
    plan = ev.with_eta._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    full = ev.metrics._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython"):
        assert node not in plan and node not in full


def test_partitioning_independence(spark):
    """The same metrics with 1 and 17 shuffle partitions and shuffled input."""
    from tripgauge.plans.evaluation import TripEvaluation
    from tripgauge.sources.fixture import load_raw_trips

    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        res = []
        for parts in (1, 17):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            raw = load_raw_trips(spark, SF001).repartition(parts)
            ev = TripEvaluation(spark, raw)
            res.append(sorted((r["segment_type"], r["segment_value"], r["trip_count"], round(r["medae_sec"], 9))
                              for r in ev.metrics.collect()))
        assert res[0] == res[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["segment_type", "segment_value", "trip_count"]


def test_oracle_equality(spark):
    """Every registered query with an oracle equals DuckDB at sf0.01."""
    import __spark_entry__ as entry
    from oracle_compare import compare, duck

    con = duck(SF01)
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    failures = []
    for name, sql in sqls.items():
        ok, msg = compare(spark, con, name, SF01, qs[name], sql)
        if not ok:
            failures.append((name, msg))
    assert not failures, failures


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_filter_reaches_scan(ev):
    plan = _plan(ev.training.select("trip_id"))
    assert "PushedFilters: [IsNotNull(pickup_datetime), LessThanOrEqual(pickup_datetime" in plan
    plan = _plan(ev.evaluation.select("trip_id"))
    assert "GreaterThan(pickup_datetime" in plan


def test_metric_scan_is_pruned(ev):
    from tripgauge.operators.metrics import error_quantiles

    plan = _plan(error_quantiles(ev.errors, approx=True))
    read = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert read and all("pickup_latitude" not in line and "trip_distance" not in line for line in read)


def test_observed_quality_report_equals_filter_stats(ev):
    from tripgauge.operators.quality import filter_stats

    observed = ev.quality_report()
    counted = {r["reject_reason"]: r["n"] for r in filter_stats(ev.measured, ev.rules).collect()}
    assert observed == counted and sum(observed.values()) == ev.raw.count()


def test_metrics_scan_error_rows_once(ev):
    """The error rows are read by the single sort job only: the metric plan reads
    the sorted table (_m, _t, segment_value, _x, _mid), never the error columns."""
    from tripgauge.operators.metrics import segment_metrics

    plan = _plan(segment_metrics(ev.errors))
    schemas = [line[line.index("ReadSchema"):] for line in plan.splitlines() if "ReadSchema" in line]
    assert schemas and all("abs_error_sec" not in r and "abs_pct_error" not in r for r in schemas)
    assert any("_mid" in r for r in schemas)


def test_histogram_ranges_from_quantiles_are_exact(ev):
    from tripgauge.operators.charts import error_histograms

    a = sorted(tuple(r) for r in error_histograms(ev.errors).collect())
    b = sorted(tuple(r) for r in error_histograms(ev.errors, qtable=ev.error_quantiles).collect())
    assert a == b
