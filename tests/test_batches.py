"""Batched writer, bucketed joins, and the keys behind a fan-out."""

import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripgauge.operators import audit
from tripgauge.operators.audit import worst_keys
from tripgauge.sources.batches import read_batched, write_batched
from tripgauge.sources.bucketed import bucketed_predictions_join, write_bucketed


def test_batches_are_row_groups_and_writes_are_whole(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.range(0, 2500, 1, 3).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("é"), "id")).alias("s"), F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'").alias("t"))
    write_batched(rows, path, rows=300_000, batchsize=400)
    files = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names]
    sizes = [pq.ParquetFile(f).metadata for f in files]
    assert len(files) == 3 and all(m.row_group(g).num_rows <= 400 for m in sizes for g in range(m.num_row_groups)) and max(m.num_row_groups for m in sizes) >= 3
    bad = rows.withColumn("s", F.when(F.col("id") == 2400, F.raise_error(F.lit("no more"))).otherwise(F.col("s")))
    with pytest.raises(Exception, match="no more"):
        write_batched(bad, path, rows=300_000, batchsize=400)
    assert sorted(files) == sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names) and len(os.listdir(path)) == 1
    write_batched(rows.limit(0), path, rows=0)
    write_batched(rows.limit(5), path)
    assert sorted(map(tuple, read_batched(spark, path).collect())) == sorted(map(tuple, rows.unionByName(rows.limit(5)).collect()))


def test_bucketed_join_moves_nothing(spark, tmp_path):
    trips = spark.range(1, 1001).select(F.col("id").alias("trip_id"), (F.col("id") * 2).alias("x"))
    preds = spark.range(501, 1501).select(F.col("id").alias("trip_id"), F.col("id").cast("double").alias("estimated_duration_sec"))
    name = f"t{random.randrange(1 << 40)}"
    write_bucketed(trips, f"{name}_a", 4, path=str(tmp_path / "a"))
    write_bucketed(preds, f"{name}_b", 4, path=str(tmp_path / "b"))
    joined = bucketed_predictions_join(spark, f"{name}_a", f"{name}_b")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert sorted(map(tuple, joined.collect())) == [(i, 2 * i, float(i)) for i in range(501, 1001)]


@pytest.mark.parametrize("candidates,tracked", [(audit.CANDIDATES, audit.TRACKED), (12, 64), (1, 16)])
def test_worst_keys_are_exact_whatever_the_summary_holds(spark, monkeypatch, candidates, tracked):
    monkeypatch.setattr(audit, "TRACKED", tracked)
    rng = random.Random(5)
    sides = [[("hot" if rng.random() < 0.4 else None if rng.random() < 0.1 else f"k{rng.randrange(60)}", rng.randrange(2)) for _ in range(1500)] for _ in range(2)]
    a, b = (spark.createDataFrame(s, "k string, j int") for s in sides)
    got = worst_keys(a, b.withColumnsRenamed({"k": "kk", "j": "jj"}), ["k", "j"], ["kk", "jj"], n=7, candidates=candidates).orderBy("place").collect()
    counts = [{}, {}]
    for side, c in zip(sides, counts):
        for k, j in side:
            if k is not None:
                c[k, j] = c.get((k, j), 0) + 1
    want = sorted(((*k, counts[0][k], counts[1][k], counts[0][k] * counts[1][k]) for k in counts[0].keys() & counts[1].keys()), key=lambda r: (-r[4], r[:2]))[:7]
    assert [tuple(r)[:5] for r in got] == want and [r.place for r in got] == list(range(1, 8))
    assert worst_keys(a, b.limit(0), ["k"]).count() == 0
