"""Small files next to the data, in any Hadoop file system: write once, list, delete."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in ``folder``; none if it isn't there."""
    p, fs = _path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Creates ``path`` with its whole content at once; FileExistsError if another writer was first."""
    p, fs = _path(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    plain = spark.sparkContext._gateway.new_array(kind, 1)
    plain[0] = kind.NONE  # never over an existing file
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(part), fs.makeQualified(p), plain)
    except Exception as error:
        fs.delete(part, False)
        if "FileAlreadyExists" in str(error):
            raise FileExistsError(path) from None
        raise


def delete_tree(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.delete(p, True)
