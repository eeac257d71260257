"""Session helpers: local sessions for tests/bench and materialisation points.

Materialised stages are Parquet tables under the shared folder named by
``spark.checkpoint.dir``. That setting is read from the session; a private
folder is created only when it is unset and the master is local (tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tripgauge") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (set one only if none is configured)."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="tripgauge-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def _stages(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tripgauge/{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{_stages(spark)}/{uuid.uuid4().hex}/{name}"


def close_stages(spark: SparkSession) -> bool:
    """Deletes all that this application has materialised in the shared folder, and nothing else. Frames over it can't be
    read any more: call it when the results are written elsewhere. True if there was anything."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(_stages(spark))
    return bool(folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True))


def drop_stages(spark: SparkSession, paths: list[str]) -> None:
    """Deletes the tables that ``materialize`` wrote at ``paths``, once nothing reads them any more."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, name: str, made: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts lineage (a lost executor recomputes from the table, not from the
    source), fixes any nondeterministic column, and gives downstream readers
    column pruning and row-group skipping. ``made`` gets the path, for ``drop_stages``.
    """
    path = stage_path(df.sparkSession, name)
    if made is not None:
        made.append(path)
    df.write.mode("overwrite").parquet(path)
    # The schema is known: read back without footer-based inference.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only after checking the row count against ``max_rows``.

    Beyond the bound the frame is returned unhinted, so the planner (and
    AQE at runtime) picks a shuffle join instead. Meant for small,
    materialised tables, where the count is cheap.
    """
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
