"""Comparing all rows of a bucket in tasks of bounded size.

Rows of a bucket with more than ``limit`` rows are dealt to chunks, and every
two chunks (a chunk with itself included) meet in a block of their own. A
block thus holds about two chunks at most, however large its bucket is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripgauge.llm.runtime import ship


def deal(rows: DataFrame, key: list[str], row_key: str, limit: int) -> DataFrame:
    """``rows`` with ``_ci`` and ``_cj``, once for each block they belong to, without buckets of one row."""
    sizes = rows.groupBy(*key).agg(F.count("*").alias("_n")).filter("_n > 1")
    some = rows.join(sizes, key)
    chunks = F.ceil(F.col("_n") / limit).cast("int")
    some = some.withColumn("_chunks", chunks).withColumn("_own", F.pmod(F.xxhash64(row_key), F.col("_chunks")).cast("int"))
    some = some.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    return some.withColumns({"_ci": F.least("_own", "_other"), "_cj": F.greatest("_own", "_other")}).drop("_n", "_chunks", "_other")


def compare(dealt: DataFrame, key: list[str], fn: Callable[[pa.Table, np.ndarray], Iterator[dict]], schema: T.StructType) -> DataFrame:
    """``fn(table, bounds)`` for tables of whole blocks; block b is rows bounds[b] to bounds[b + 1]."""
    ship(dealt.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema

    by = [*key, "_ci", "_cj"]
    arrow = to_arrow_schema(schema)

    def whole(table: pa.Table):
        changed = np.zeros(table.num_rows, bool)
        changed[0] = True
        for name in by:
            values = table.column(name).combine_chunks().to_numpy(zero_copy_only=False)
            changed[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(changed)

    def emit(table, bounds):
        for columns in fn(table, bounds):
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            starts = whole(table)
            if len(starts) > 1:
                yield from emit(table.slice(0, starts[-1]), starts)
            held = table.slice(starts[-1])
        if held is not None:
            yield from emit(held, np.array([0, held.num_rows]))

    return dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, schema)


def forest(near: Callable[[int, np.ndarray], np.ndarray], n: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of n rows. ``near(i, rest)``: mask of the rows in ``rest`` linked with row i.

    Every row reached leaves ``rest``, so a dense group of n rows yields n - 1 edges, not all pairs.
    """
    rest, edges = np.arange(n), []
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            hit = near(i, rest)
            found = rest[hit]
            if len(found):
                edges += [(i, int(j)) for j in found]
                queue += found.tolist()
                rest = rest[~hit]
    return edges
