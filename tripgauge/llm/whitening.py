"""Embedding whitening: principal components of all vectors by FEAST, and every vector projected to unit covariance.

Spark sums counts, exact per-dimension totals and centred products over all
rows; only matrices of the dimension's size reach the driver. The eigenpairs
come from ``feast``: one Spark task an interval of the spectrum.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgauge.llm import feast
from tripgauge.llm.runtime import map_batches, ship
from tripgauge.session import materialize

#: Longest vectors whose covariance the operator holds on the driver and in a task (16 million doubles, 128 MB).
MAX_DIMS = 4096
#: Scaled entries beyond this count as this, so that sums of a batch stay exact.
LARGEST = float(1 << 45)
#: Values of vectors held in a step.
STEP_VALUES = 1 << 18


def _steps(batch: pa.RecordBatch, column: str, dims: int):
    rows = max(1, STEP_VALUES // max(dims, 1))
    for start in range(0, batch.num_rows, rows):
        part = batch.slice(start, rows)
        yield part, part.column(part.schema.get_field_index(column)).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dims)


def _totals(rows: DataFrame, column: str, dims: int, of: Callable[[np.ndarray], np.ndarray], kind: T.DataType) -> list[list]:
    """Column sums of the tables that ``of`` makes of the steps (of its product with itself: one row a row of it).

    A partition adds up its steps before anything moves; the partitions' sums are added by a keyed aggregation, so the
    driver gets as many rows as ``of`` gives, whatever the number of partitions.
    """
    schema = T.StructType([T.StructField("row", T.IntegerType()), T.StructField("sums", T.ArrayType(kind))])
    exact = not isinstance(kind, T.DoubleType)
    ship(rows.sparkSession)

    def run(batches):
        held, values = None, 0
        for batch in batches:
            for _, x in _steps(batch, column, dims):
                part = of(x)
                held = part if held is None else held + part
                values += len(x)
                if exact and values >= 1 << 16:  # below 2^45 * 2^16 the sums are exact
                    yield from emit(held)
                    held, values = None, 0
        if held is not None:
            yield from emit(held)

    def emit(held):
        arrow = pa.list_(pa.int64() if exact else pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held)), pa.int32()), pa.array(held.tolist(), arrow)], names=["row", "sums"])

    parts = rows.select(column).mapInArrow(run, schema)
    cells = parts.select("row", F.posexplode("sums").alias("at", "v"))
    summed = cells.groupBy("row", "at").agg(F.sum(F.col("v").cast("decimal(38,0)") if exact else F.col("v")).alias("v"))
    lines = summed.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("line"))  # one value a dimension
    return [[c["v"] for c in r["line"]] for r in lines.orderBy("row").collect()]


def components(rows: DataFrame, covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues (falling, at most ``most``, those that are zero to double precision left out) and eigenvectors
    (columns). One Spark task an interval; the number found is held against the inertia count of the whole range."""
    trace = float(np.trace(covariance))
    if not trace > 0 or not most:
        return np.empty(0), np.empty((len(covariance), 0))
    unit = covariance / trace
    cuts = feast.intervals(unit, most)
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(unit)  # at most MAX_DIMS^2 doubles
    plan = spark.createDataFrame([(i, *map(float, c[:2]), int(c[2])) for i, c in enumerate(cuts)], "part int, low double, high double, count int")

    def one(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        cut = frame.iloc[0]
        values, vectors = feast.solve(shared.value, cut["low"], cut["high"], int(cut["count"]))
        return pd.DataFrame({"value": values, "vector": list(vectors.T)})

    found = plan.groupBy("part").applyInPandas(one, "value double, vector array<double>").collect()  # ``most`` pairs, and ties with the last
    shared.unpersist()
    found.sort(key=lambda r: -r["value"])
    if len(found) != feast.Inertia(unit).above(cuts[-1][0]):
        raise ArithmeticError("the inertia count finds other eigenvalues than the contours")
    found = [r for r in found[:most] if r["value"] > 1e-11 * found[0]["value"]]
    return np.array([r["value"] for r in found]) * trace, np.array([r["vector"] for r in found]).reshape(len(found), -1).T


def whiten(rows: DataFrame, scale: float = 64, shift: int = 1_000_000, most: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row per sound input row and component: the input's other columns, component, n, deviation, whitened, explained, identity_error.

    An entry c becomes the integer x = floor(scale * c) + shift. Components are the unit eigenvectors of the covariance of
    all sound rows' x (divisor n), from 1 by falling eigenvalue, ``most`` at most; those whose eigenvalue is zero to double
    precision can't be whitened and are left out (constant vectors, or one row: no rows come out). deviation is the exact
    sum of (n * x - S)^2, decimal(38,0) (null beyond it); whitened the projection of x - S/n over the square root of the
    eigenvalue; explained the eigenvalue over the trace; identity_error how far the covariance of whitened is from the
    identity, at most. A row is sound if its vector isn't null, holds no null or non-finite entry, and has the length
    that most rows have (of equally frequent lengths the greatest). Scaled entries beyond 2^45 count as that. Repeated rows count each
    time. Null ids stay. Input columns of the new names are replaced. An empty table gives an empty one; vectors longer
    than MAX_DIMS are an error.
    """
    new = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    names = [c for c in rows.columns if c not in new and c != vector_col]
    if id_col not in names:
        raise ValueError(f"no column {id_col}")
    wide = F.transform(F.col(f"`{vector_col}`"), lambda v: v.cast("double"))
    good = F.col(f"`{vector_col}`").isNotNull() & F.forall(wide, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = [F.col(f"`{c}`") for c in names]
    sizes = rows.filter(good).groupBy(F.size(f"`{vector_col}`").alias("dims")).count().agg(F.max(F.struct("count", "dims")).alias("m")).first()["m"]
    dims = sizes["dims"] if sizes else 0
    if dims > MAX_DIMS:
        raise ValueError(f"vectors of {dims} entries; the covariance is held up to {MAX_DIMS}")
    bound = lambda v: F.greatest(F.least(v, F.lit(LARGEST)), F.lit(-LARGEST))
    x = F.transform(wide, lambda v: F.floor(bound(v * F.lit(float(scale)))).cast("long") + F.lit(shift))
    whole = rows.filter(good & (F.size(f"`{vector_col}`") == dims)).select(F.struct(*kept).alias("own"), x.alias("x"))
    source = materialize(whole, "whitening_x")
    n = source.count() if dims else 0
    shape = T.StructType([T.StructField("own", source.schema["own"].dataType), T.StructField("deviation", T.DecimalType(38, 0)),
                          T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    last = [T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.DecimalType(38, 0)),
            T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())]
    nothing = rows.sparkSession.createDataFrame([], T.StructType([*(f for f in rows.schema.fields if f.name in names), *last]))
    if not n:
        return nothing
    sums = [int(v) for v in _totals(source, "x", dims, lambda x: x.sum(axis=0, keepdims=True), T.LongType())[0]]
    base = np.array([s // n for s in sums], np.int64)  # integers near the mean: what is left is small, so doubles keep it exactly
    rest = np.array([(s - n * int(b)) for s, b in zip(sums, base)], object)  # 0 <= rest < n
    mean = np.array([r / n for r in rest], np.float64)

    def product(x: np.ndarray) -> np.ndarray:
        y = (x - base).astype(np.float64) - mean
        return y.T @ y

    covariance = np.array(_totals(source, "x", dims, product, T.DoubleType())) / n
    values, vectors = components(rows, (covariance + covariance.T) / 2, most)
    if not len(values):
        return nothing
    weights = vectors / np.sqrt(values)
    small = rest.astype(np.int64)

    def project(batch):
        for part, x in _steps(batch, "x", dims):
            near = x - base
            if float(np.abs(near).max() + 1) ** 2 * float(n) ** 2 * dims < 2.0 ** 62:
                deviation = ((n * near - small) ** 2).sum(axis=1).tolist()
            else:
                deviation = ((n * near.astype(object) - rest) ** 2).sum(axis=1).tolist()
            deviation = [v if v < 10 ** 38 else None for v in deviation]
            yield {"own": part.column(0), "deviation": pa.array(deviation, pa.decimal128(38, 0)), "whitened": pa.array(list((near - mean) @ weights))}

    done = materialize(map_batches(source, project, shape), "whitening_rows")
    k = len(values)
    middle = np.array(_totals(done, "whitened", k, lambda w: w.sum(axis=0, keepdims=True), T.DoubleType())[0]) / n
    second = np.array(_totals(done, "whitened", k, lambda w: (w - middle).T @ (w - middle), T.DoubleType())) / n
    error = float(np.abs(second - np.eye(k)).max())
    shares = F.array(*(F.lit(float(v)) for v in values / np.trace(covariance)))
    out = done.select("own.*", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return out.select(*kept, (F.col("_at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      F.element_at(shares, F.col("_at") + 1).alias("explained"), F.lit(error).alias("identity_error"))
