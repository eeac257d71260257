"""Distributed order statistics against brute force, independent of partitioning."""

import random

import numpy as np
from pyspark.sql import functions as F

from tripgauge.operators.ranking import exact_percentiles, group_sketches, merge_sketches, row_numbers


def _data(spark, parts, seed=7, n=3000):
    rnd = random.Random(seed)
    # one hot group holds a third of the rows, many ties
    rows = [(i, "hot" if i % 3 == 0 else f"g{i % 11}", float(rnd.randint(0, 50)) if i % 5 else rnd.random())
            for i in range(n)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "id long, g string, x double").repartition(parts), rows


def test_exact_percentiles_match_numpy(spark):
    for parts in (1, 4, 17):
        df, rows = _data(spark, parts)
        got = {r["g"]: (r["p50"], r["p90"], r["p5"]) for r in
               exact_percentiles(df, "x", [0.5, 0.9, 0.05], by=["g"], names=["p50", "p90", "p5"]).collect()}
        groups = {}
        for _, g, x in rows:
            groups.setdefault(g, []).append(x)
        assert set(got) == set(groups)
        for g, xs in groups.items():
            want = np.percentile(np.array(xs), [50, 90, 5], method="linear")
            assert np.allclose(got[g], want, rtol=0, atol=1e-12), (parts, g)


def test_exact_percentiles_global_and_builtin(spark):
    df, rows = _data(spark, 5)
    got = exact_percentiles(df, "x", [0.7], names=["p"]).first()["p"]
    want = df.agg(F.percentile("x", 0.7)).first()[0]
    assert abs(got - want) < 1e-12


def test_exact_percentiles_counts_and_nulls(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", None), (3, "a", 3.0), (4, "b", None)], "id long, g string, x double")
    got = {r["g"]: (r["m"], r["n"]) for r in exact_percentiles(df, "x", [0.5], by=["g"], names=["m"], count_col="n").collect()}
    assert got == {"a": (2.0, 2)}


def test_row_numbers_dense_and_ordered(spark):
    for parts in (1, 3, 17):
        df, rows = _data(spark, parts)
        out = row_numbers(df, ["x", "id"], "rn").select("id", "x", "rn").collect()
        want = sorted(rows, key=lambda r: (r[2], r[0]))
        rank = {r[0]: i + 1 for i, r in enumerate(want)}
        assert sorted(r["rn"] for r in out) == list(range(1, len(rows) + 1))
        assert all(rank[r["id"]] == r["rn"] for r in out)


def test_sliver_is_small_and_ties_cost_nothing(spark, monkeypatch):
    """Few rows reach the exact sort; none do if all values are equal; a missed bracket is widened."""
    from tripgauge.operators import ranking

    sorted_rows = []
    plain = ranking._sorted_numbered

    def watched(df, order, name, **kw):
        t = plain(df, order, name, **kw)
        sorted_rows.append(t.count())
        return t

    monkeypatch.setattr(ranking, "_sorted_numbered", watched)
    n = 200_000
    df = spark.range(n).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 1_000_003).cast("double").alias("x"))
    want = {r["g"]: r["p"] for r in df.groupBy("g").agg(F.percentile("x", [0.0, 0.5, 0.9, 1.0]).alias("p")).collect()}
    got = {r["g"]: [r["a"], r["b"], r["c"], r["d"]] for r in
           exact_percentiles(df, "x", [0.0, 0.5, 0.9, 1.0], by=["g"], names=list("abcd"), max_groups=3).collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[g], want[g], rtol=1e-12) for g in want)
    assert 0 < sorted_rows[-1] < 0.01 * n
    same = spark.range(5000).select(F.lit(None).cast("string").alias("g"), F.lit(2.5).alias("x"))
    assert [tuple(r) for r in exact_percentiles(same, "x", [0.5], by=["g"], names=["m"], count_col="n").collect()] == [(None, 2.5, 5000)]
    assert sorted_rows[-1] == 0
    monkeypatch.setattr(ranking.F, "percentile_approx", lambda c, p, a: F.array(*[F.max(c)] * len(p)))
    got = {r["g"]: r["m"] for r in exact_percentiles(df, "x", [0.5], by=["g"], names=["m"]).collect()}
    assert all(abs(got[g] - want[g][1]) < 1e-6 for g in want)


def test_hot_group_spreads_over_partitions(spark):
    """A group with a third of the rows (and long runs of equal values) is split
    across range partitions rather than landing in one task."""
    from tripgauge.operators.ranking import _partition_offsets, _sorted_numbered

    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    # AQE would merge the 16 small partitions of this tiny table into one.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df, _ = _data(spark, 8, n=30000)
        base = df.select("g", F.col("x").alias("_x"), F.col("id").alias("_tb"))
        t = _sorted_numbered(base, ["g", "_x", "_tb"], "hot_check", drop=["_tb"])
        parts = _partition_offsets(t, ["g"]).where(F.col("g") == "hot").count()
        assert parts >= 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_row_numbers_with_a_third_tied_on_the_key(spark):
    rows = [(i, 0 if i % 3 == 0 else i) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, k long").repartition(7)
    out = row_numbers(df, ["k", "id"], "rn").collect()
    assert sorted(r["rn"] for r in out) == list(range(1, 6001))
    by_rn = [(r["k"], r["id"]) for r in sorted(out, key=lambda r: r["rn"])]
    assert by_rn == sorted(by_rn)


def test_group_sums_match_brute_force(spark):
    df, rows = _data(spark, 6)
    sums = {"s": lambda x: x, "le10": lambda x: F.when(x <= 10.0, 1.0).otherwise(0.0)}
    want = {}
    for _, g, x in rows:
        s, le = want.get(g, (0.0, 0.0))
        want[g] = (s + x, le + (1.0 if x <= 10.0 else 0.0))
    for bound in (None, 20):
        got = {r["g"]: (r["s"], r["le10"]) for r in exact_percentiles(
            df, "x", [0.5], by=["g"], max_groups=bound, sums=sums).collect()}
        assert got.keys() == want.keys()
        for g in want:
            assert abs(got[g][0] - want[g][0]) < 1e-6 and got[g][1] == want[g][1], (bound, g)


def test_stored_sketches_give_the_same_percentiles(spark):
    rows = spark.range(60_000).select((F.col("id") % 7).alias("g"), F.expr("CASE WHEN id % 3 = 0 THEN 5D ELSE sqrt(id) * (id % 11) END").alias("x"), (F.col("id") % 2).alias("load"))
    rows = rows.unionByName(spark.createDataFrame([(None, 1.0, 0), (None, 2.0, 1), (9, None, 0)], "g long, x double, load long"))
    sums = {"total": lambda x: x}
    stored = [group_sketches(rows.where(F.col("load") == k), "x", ["g"], sums) for k in (0, 1)]
    probs, names = [0.0, 0.25, 0.5, 0.9, 1.0], list("abcde")
    got = exact_percentiles(rows, "x", probs, ["g"], names, count_col="n", sums=sums, sketches=merge_sketches(stored, ["g"]))
    want = exact_percentiles(rows, "x", probs, ["g"], names, count_col="n", sums=sums)
    key = lambda r: (r["g"] is None, r["g"])
    a, b = sorted(got.collect(), key=key), sorted(want.collect(), key=key)
    assert [r.asDict() | {"total": round(r["total"], 3)} for r in a] == [r.asDict() | {"total": round(r["total"], 3)} for r in b] and len(a) == 8


def test_sketched_percentiles_scan_the_rows_once_less(spark):
    rows = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    made = group_sketches(rows, "x")
    stored = spark.createDataFrame(made.collect(), made.schema)
    seen = spark.sparkContext.accumulator(0)
    counted = rows.mapInPandas(lambda it: (seen.add(len(b)) or b for b in it), "x double")
    assert exact_percentiles(counted, "x", [0.5], sketches=stored).first()[0] == 499.5
    with_sketches = seen.value
    assert exact_percentiles(counted, "x", [0.5], accuracy=100).first()[0] == 499.5  # wide brackets, so that both sort a sliver
    assert seen.value - with_sketches == with_sketches + 1000
