"""The load step on Structured Streaming: trip files arriving in a folder.

Each micro-batch goes through the same operators as the batch path
(normalise, parse, derive, quality cascade). ``foreachBatch`` writes the kept
rows and the per-rule reject counts under a ``batch_id=<n>`` folder with
overwrite semantics, so a batch replayed after a failure replaces its own
output instead of duplicating it (exactly-once output on top of the
at-least-once batch delivery). Dense trip numbering needs the global pickup
order and stays a batch step over the accumulated table
(``assign_trip_id``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tripgauge.operators.columns import derive_measures, derive_segments, normalize_columns, parse_timestamps, require_columns
from tripgauge.operators.quality import OK, quality_rules, reject_reason


def labelled_stream(raw: DataFrame, bbox: bool = False) -> DataFrame:
    """Streaming (or batch) raw trips -> derived columns + reject_reason."""
    return reject_reason(derive_measures(parse_timestamps(require_columns(normalize_columns(raw)))),
                         quality_rules(bbox=bbox))


def start_clean_trips_stream(spark: SparkSession, source_dir: str, schema: StructType | str, sink_dir: str,
                             checkpoint_dir: str, fmt: str = "csv", available_now: bool = True,
                             max_files_per_trigger: int | None = None,
                             numbering: str = "monday") -> StreamingQuery:
    """Start the stream; ``sink_dir/clean`` and ``sink_dir/rejects`` receive one folder per batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    labelled = labelled_stream(reader.load(source_dir))
    base = sink_dir.rstrip("/")
    reasons = [name for name, _ in quality_rules()] + [OK]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # One read of the batch: the reject counts are observed while its clean rows are written.
        seen = Observation(f"rejects_{batch_id}")
        counted = batch.observe(seen, *[F.count(F.when(F.col("reject_reason") == r, 1)).alias(r) for r in reasons])
        clean = derive_segments(counted.where(F.col("reject_reason") == OK).drop("reject_reason"), numbering)
        clean.write.mode("overwrite").parquet(f"{base}/clean/batch_id={batch_id}")
        counts = [(r, int(n)) for r, n in seen.get.items() if n]
        (batch.sparkSession.createDataFrame(counts, "reject_reason string, n long").coalesce(1)
         .write.mode("overwrite").parquet(f"{base}/rejects/batch_id={batch_id}"))

    writer = labelled.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def read_stream_output(spark: SparkSession, sink_dir: str) -> tuple[DataFrame, DataFrame]:
    """(clean rows, reject counts summed over batches) written by the stream."""
    base = sink_dir.rstrip("/")
    clean = spark.read.parquet(f"{base}/clean")
    rejects = (spark.read.parquet(f"{base}/rejects").groupBy("reject_reason")
               .agg(F.sum("n").cast("long").alias("n")))
    return clean, rejects
