"""Sinks: trip tables, predictions and metric CSVs; row-count checks; views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripgauge.operators.estimate import dedupe_predictions
from tripgauge.schema import ESTIMATE, TRIP_ID

_MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}

# FIXED VALUES: JDBC write sizing - one writer per 100,000 rows, 1..200 writers,
# 10,000-row insert batches.
ROWS_PER_WRITER = 100_000
MAX_WRITERS = 200
INSERT_BATCH = 10_000


def jdbc_writers(rows: int, most: int = MAX_WRITERS) -> int:
    """Number of parallel JDBC writers for ``rows`` rows; ``most`` is what the database accepts."""
    return max(1, min(most, rows // ROWS_PER_WRITER))


def write_trips_table(df: DataFrame, target: str, mode: str = "replace", fmt: str = "parquet",
                      jdbc: Mapping[str, str] | None = None, batchsize: int = INSERT_BATCH,
                      num_partitions: int | None = None, verify: bool = False) -> int:
    """Write with mode replace / append / fail; returns the rows written.

    JDBC ``replace`` truncates instead of dropping, so dependent views survive.
    ``num_partitions`` bounds the JDBC connections (``jdbc_writers`` sizes it
    from a known row count); each inserts ``batchsize`` rows per round trip.
    The row count is observed during the write itself (no second pass). With
    ``verify`` (mode replace or fail, a file format that keeps types) so is a
    sum of row hashes, and the table is read back and compared.
    """
    if verify and mode == "append":
        raise ValueError("an appended-to table holds other rows as well: verify the load (TripTable does)")
    obs = Observation("written")
    schema = df.schema
    df = df.observe(obs, *(observed_content(df) if verify else [F.count(F.lit(1)).alias("rows")]))
    w = df.write.mode(_MODES[mode])
    if fmt == "jdbc":
        w = w.format("jdbc").options(**(jdbc or {})).option("dbtable", target).option("batchsize", batchsize)
        if mode == "replace":
            w = w.option("truncate", "true")
        if num_partitions:
            w = w.option("numPartitions", num_partitions)
        w.save()
    else:
        w.format(fmt).option("header", True).save(target) if fmt == "csv" else w.format(fmt).save(target)
    if verify:
        verify_content(df.sparkSession.read.schema(schema).format(fmt).load(target), int(obs.get["rows"]), int(obs.get["content"] or 0))
    return int(obs.get["rows"])


def content_hash(rows: DataFrame) -> Column:
    """A 64-bit hash of all columns of a row; which of them are null counts, too."""
    cols = [F.col(f"`{c}`") for c in sorted(rows.columns)]
    return F.xxhash64(*cols, F.array(*[c.isNull() for c in cols]))


def observed_content(rows: DataFrame) -> list[Column]:
    """Aggregates ``rows`` (count) and ``content``: the sum of the rows' hashes, whatever their order. For ``observe`` or ``agg``."""
    return [F.count(F.lit(1)).alias("rows"), F.sum(content_hash(rows).cast("decimal(38,0)")).alias("content")]


def verify_content(written: DataFrame, rows: int, content: int) -> None:
    """AssertionError unless the table holds as many rows, and the same ones, as were told: a changed, swapped or
    doubled value with the right count is found."""
    found = written.agg(*observed_content(written)).first()
    if (found["rows"], int(found["content"] or 0)) != (rows, content):
        raise AssertionError(f"the table is not what was written: {found['rows']} rows with content {found['content']}, wrote {rows} with {content}")


def verify_row_count(written: DataFrame, expected: int) -> int:
    n = written.count()
    if n != expected:
        raise AssertionError(f"row count mismatch: wrote {expected}, table has {n}")
    return n


def write_predictions(preds: DataFrame, target: str, order_col: str | None = None,
                      fmt: str = "parquet", jdbc: Mapping[str, str] | None = None) -> int:
    """Keyed prediction table: one row per trip_id (latest ``order_col`` wins), then overwrite.

    Without ``order_col`` a key that occurs twice is an error: a join on such a
    table would multiply trips.
    """
    if order_col is not None:
        preds = dedupe_predictions(preds, order_col)
    else:
        twice = preds.groupBy(TRIP_ID).count().where("count > 1").limit(1).collect()
        if twice:
            raise ValueError(f"{TRIP_ID} {twice[0][TRIP_ID]} has {twice[0]['count']} predictions: give order_col to choose one")
    return write_trips_table(preds.select(TRIP_ID, F.col(ESTIMATE).cast("double").alias(ESTIMATE)),
                             target, "replace", fmt=fmt, jdbc=jdbc)


def write_metrics_csv(tables: Mapping[str, DataFrame], directory: str) -> dict[str, str]:
    """One headed CSV per metric table (each at most a few dozen rows, so one file each)."""
    out = {}
    for name, df in tables.items():
        path = f"{directory.rstrip('/')}/{name}"
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
        out[name] = path
    return out


def register_views(spark: SparkSession, stages: Mapping[str, DataFrame]) -> list[str]:
    for name, df in stages.items():
        df.createOrReplaceTempView(name)
    return sorted(stages)
