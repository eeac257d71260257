"""Embedding near-dedup against DuckDB and against all products."""

import duckdb
import numpy as np
import pytest
from tripgauge.llm import embeddings, queries

SF = "/root/testdata/sf0.001"


def brute(rows, least=0.98):
    """rows: (id, vector, label); ids differ."""
    good = [(i, np.array(v, float), g) for i, v, g in rows if i is not None and v and g is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {i: set() for i, _, _ in good}
    for a, (i, x, g) in enumerate(good):
        for j, y, h in good[:a]:
            if g == h and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= least:
                links[i].add(j)
                links[j].add(i)
    out = {}
    for i, _, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = (len(links.get(i, ())), min(seen), i == min(seen))
    return out


def test_op10_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = sorted(con.sql(queries.OP10_SQL).fetchall())
    got = sorted(map(tuple, queries.op10_embedding_near_dedup(spark, SF).collect()))
    assert got == want


@pytest.mark.parametrize("limit", [40, 1024])
def test_crowds_and_cells_lose_no_link(spark, limit, monkeypatch):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(6, 16))
    rows = [(i, [float(v) for v in np.float32(centre[i % 6] + rng.normal(size=16) * (0.05 if i % 3 else 0.25))], 1 if i % 4 else 2) for i in range(700)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(50)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(embeddings.fit_cells, "__defaults__", (40, 4))  # many cells
    out = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(frame, limit=limit).collect()}
    assert out == brute(rows)


def test_unusable_vectors_and_clashes(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1, 9), (2, [2.0, 0.0], 1, 9), (3, [1.0, 0.0], None, 9), (4, None, 1, 9), (5, [0.0, 0.0], 1, 9), (6, [nan, 1.0], 1, 9), (7, [inf, 1.0], 1, 9),
            (8, [1.0, None], 1, 9), (9, [], 1, 9), (10, [1.0, 0.0, 0.0], 1, 9), (11, [1.0, 0.0, 0.0], 1, 9), (12, [1.0, 0.0], 2, 9), (13, [1e-38, -0.0], 1, 9)]
    frame = spark.createDataFrame([*rows, (None, [1.0, 0.0], 1, 9)], "vec_id long, embedding array<float>, label int, n_links int")
    out = embeddings.near_duplicates(frame).collect()
    assert len(out) == 14
    want = brute([r[:3] for r in rows])
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out if r.vec_id} == want
    assert [(r.n_links, r.component_id, r.kept) for r in out if r.vec_id is None] == [(0, None, False)]
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)], "vec_id long, embedding array<float>, label int")
    assert [(r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(twice).collect()] == [(1, 1, True)] * 2
