"""FEAST against dense eigensolvers; whitening against plain numpy and exact integers."""

import math

import numpy as np
import pytest
from tripgauge.llm import feast, queries, whitening

SF = "/root/testdata/sf0.001"


def matrix_of(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return q @ np.diag(values) @ q.T


SPECTRA = {"decay": 0.7 ** np.arange(40), "flat": 1 + 0.01 * np.arange(60) / 60, "ties": np.repeat([5.0, 3, 1], 12), "one": np.ones(50), "spike": np.array([1e6] + [1.0] * 3 + [1e-3] * 20),
           "low rank": np.array([3.0, 2, 1] + [0] * 30), "small": np.array([2.0]), "two": np.array([1.0, 4]), "random": np.random.default_rng(5).random(70)}


@pytest.mark.parametrize("name", SPECTRA)
def test_feast_finds_every_leading_pair(name):
    a = matrix_of(SPECTRA[name])
    a = (a + a.T) / 2
    a /= np.trace(a)
    want = np.sort(np.linalg.eigvalsh(a))[::-1]
    cuts = feast.intervals(a, 32)
    assert all(x[0] == y[1] for x, y in zip(cuts, cuts[1:])) and sum(c[2] for c in cuts) >= min(32, len(a))
    found = [feast.solve(a, *c) for c in cuts]
    values = np.concatenate([v for v, _ in found])
    vectors = np.hstack([x for _, x in found])
    assert np.abs(values - want[:len(values)]).max() < 1e-13 * max(want[0], 1)
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-9


def test_inertia_counts():
    values = np.random.default_rng(2).standard_normal(30)
    inertia = feast.Inertia(matrix_of(values))
    for shift in [*(values[:9] + 1e-6), *(values[:9] - 1e-6), -9, 9]:
        assert inertia.above(shift) == (values > shift).sum()


def brute(vectors, most=32):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors])
    n, total = len(x), x.sum(axis=0)
    deviation = ((n * x.astype(object) - total.astype(object)) ** 2).sum(axis=1)
    y = (x - total // n) - (total % n) / n
    values, axes = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)[:most]
    return n, deviation, y, values[order], axes[:, order], values.sum()


def test_op13_matches_brute_force(spark):
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    rows = {i: v for i, v in rows.items() if v is not None and None not in v and np.isfinite(v).all()}
    ids = sorted(rows)
    n, deviation, y, values, axes, trace = brute([rows[i] for i in ids])
    out = queries.op13_embedding_whitening(spark, SF).collect()
    assert len(out) == 32 * len(ids) and {r.n for r in out} == {n} and max(r.identity_error for r in out) < 1e-9 and len({r.identity_error for r in out}) == 1
    at = {i: k for k, i in enumerate(ids)}
    got = np.zeros((len(ids), 32))
    for r in out:
        got[at[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == deviation[at[r.vec_id]] and abs(r.explained / (values[r.component - 1] / trace) - 1) < 1e-9
    want = y @ axes / np.sqrt(values)
    sign = np.sign((got * want).sum(axis=0))
    assert np.abs(got * sign - want).max() < 1e-6


def test_awkward_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(c) for c in rng.standard_normal(5)], "a") for i in range(40)] + [(3, [1.0, 2.0, 3.0, 4.0, 5.0], None)] * 2
    odd = [(90, None, "x"), (91, [], "x"), (92, [1.0, None, 1.0, 1.0, 1.0], "x"), (93, [float("nan")] * 5, "x"), (94, [float("inf")] * 5, "x"), (95, [1.0], "x")]
    frame = spark.createDataFrame(rows + [(None, [0.0] * 5, "z")] + odd, "vec_id long, embedding array<double>, n string")
    out = whitening.whiten(frame, most=3).collect()
    good = [r[1] for r in rows] + [[0.0] * 5]
    n, deviation, y, values, axes, trace = brute(good, 3)
    assert len(out) == 3 * n == 129 and {r.n for r in out} == {43} and out[0].identity_error < 1e-9
    assert sorted(int(r.deviation) for r in out if r.component == 1) == sorted(deviation.tolist())
    assert whitening.whiten(frame.limit(0)).count() == 0 and whitening.whiten(frame.filter("vec_id = 1")).count() == 0


def test_rank_and_large_entries(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0]) for i in range(30)]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id int, embedding array<float>")).collect()
    assert len(out) == 30 and abs(out[0].explained - 1) < 1e-12
    rows = [(0, [1e300, 0.0]), (1, [-1e300, 1.0]), (2, [5.0, 3.0])]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id int, embedding array<double>")).collect()
    by = {r.vec_id: int(r.deviation) for r in out if r.component == 1}
    x = [[min(max(math.floor(64 * c), -2 ** 45), 2 ** 45) + 1_000_000 for c in v] for _, v in rows]
    assert by == {i: sum((3 * a - sum(c)) ** 2 for a, c in zip(row, zip(*x))) for i, row in enumerate(x)}
