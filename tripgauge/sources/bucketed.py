"""Trips and predictions kept in buckets of the trip key, so that joining them moves no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripgauge.schema import ESTIMATE, TRIP_ID


def write_bucketed(df: DataFrame, table: str, buckets: int, key: str = TRIP_ID, path: str | None = None) -> DataFrame:
    """Stores ``df`` as the catalog table ``table``, hashed into ``buckets`` files by ``key`` and sorted in them; returns the table.

    One exchange now saves one at every later join on the key with a table of as many buckets. Choose them for files of
    some hundred MB. ``path`` puts the files there instead of in the warehouse.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def bucketed_predictions_join(spark: SparkSession, trips: str, predictions: str, key: str = TRIP_ID) -> DataFrame:
    """The stored trips with their stored estimates: a merge join, bucket by bucket, without an exchange on either side."""
    preds = spark.table(predictions).select(key, ESTIMATE)
    return spark.table(trips).join(preds.hint("merge"), key)
