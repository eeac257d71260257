"""Helpers shared by the operators: bounded Arrow batches and worker imports."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Text bytes that one step of a batch operator holds at a time; a longer single text forms its own step.
STEP_BYTES = 8 << 20
#: Bytes of an Arrow batch that Spark sends to a worker inside ``small_batches`` (about; a longer row forms its own batch).
BATCH_BYTES = 2 << 20


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package even if the driver's working folder is elsewhere."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


@contextmanager
def small_batches(spark: SparkSession, limit: int = BATCH_BYTES) -> Iterator[None]:
    """What runs inside sends Arrow batches of about ``limit`` bytes to its workers. By Spark's default a batch has 10,000 rows or
    64 MB, which an executor holds several times outside its heap, for each task. What is only planned inside isn't bound by it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(limit))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def steps(batch: pa.RecordBatch, text_col: str, limit: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of ``batch`` with at most ``limit`` text bytes each (one row at least), and their texts as UTF-8; null is empty."""
    texts = batch.column(batch.schema.get_field_index(text_col))
    start, held, out = 0, 0, []
    for i in range(len(texts)):
        value = texts[i].as_buffer() if texts[i].is_valid else None
        text = value.to_pybytes() if value is not None else b""
        if out and held + len(text) > limit:
            yield batch.slice(start, i - start), out
            start, held, out = i, 0, []
        out.append(text)
        held += len(text)
    if out:
        yield batch.slice(start), out


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` for functions that yield column dictionaries; ``fn`` gets one Arrow batch."""
    ship(df.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for columns in fn(batch):
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) and c.type == f.type else
                     (c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type))
                     for f, c in ((f, columns[f.name]) for f in arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def carried(df: DataFrame, drop: set[str]) -> list[T.StructField]:
    """The fields an operator passes through: all but those it makes itself (an input column of such a name is replaced)."""
    return [f for f in df.schema.fields if f.name not in drop]
