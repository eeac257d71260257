"""Batched writer as a Python data source: tasks write batches of rows, the driver commits or aborts the whole write.

For targets that Spark has no sink for. This one writes Parquet files whose row
groups are the batches, staged out of readers' sight; the commit of the write
is one rename of the staged folder. A task that fails removes what it wrote,
and a failed write leaves nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripgauge.sources.sinks import INSERT_BATCH, jdbc_writers

NAME = "trip_batches"


def register_batches(spark: SparkSession) -> str:
    """Makes the format known to the session; its classes travel to the workers by value."""
    from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

    class Written(WriterCommitMessage):
        def __init__(self, file, rows):
            self.file, self.rows = file, rows

    class Writer(DataSourceArrowWriter):
        def __init__(self, options, schema):
            import uuid

            self.path, self.batch, self.schema = options["path"].rstrip("/"), int(options.get("batchsize", "10000")), schema
            self.load = uuid.uuid4().hex
            store, staged, _ = self._store()
            store.create_dir(staged, recursive=True)  # here alone: a task that outlives an abort finds no folder to write to

        def _store(self):
            """The file system and the staged and final folders in it. A leading underscore hides a folder from readers."""
            from pyarrow import fs

            store, base = fs.FileSystem.from_uri(self.path) if ":" in self.path.split("/", 1)[0] else (fs.LocalFileSystem(), self.path)
            return store, f"{base}/_staged-{self.load}", f"{base}/load={self.load}"

        def write(self, iterator):
            import uuid

            import pyarrow as pa
            import pyarrow.parquet as pq
            from pyarrow import fs
            from pyspark.sql.pandas.types import to_arrow_schema

            store, staged, _ = self._store()
            shape = to_arrow_schema(self.schema)
            file, rows, held, size, writer = f"{staged}/part-{uuid.uuid4().hex}.parquet", 0, [], 0, None
            try:
                writer = pq.ParquetWriter(file, shape, filesystem=store)
                for batch in iterator:
                    held.append(batch)
                    size += batch.num_rows
                    while size >= self.batch:
                        table = pa.Table.from_batches(held).cast(shape)
                        writer.write_table(table.slice(0, self.batch), row_group_size=self.batch)
                        rest = table.slice(self.batch)
                        held, size, rows = rest.to_batches(), rest.num_rows, rows + self.batch
                if size:
                    writer.write_table(pa.Table.from_batches(held).cast(shape))
                writer.close()
            except BaseException:
                if writer is not None:
                    writer.close()
                if store.get_file_info(file).type == fs.FileType.File:
                    store.delete_file(file)
                raise
            return Written(file.rsplit("/", 1)[1], rows + size)

        def commit(self, messages):
            from pyarrow import fs

            store, staged, final = self._store()
            good = {m.file for m in messages if m is not None}
            for info in store.get_file_info(fs.FileSelector(staged)):  # of attempts that were lost after they had written
                if info.base_name not in good:
                    store.delete_file(info.path)
            store.move(staged, final)

        def abort(self, messages):
            from pyarrow import fs

            store, staged, _ = self._store()
            if store.get_file_info(staged).type != fs.FileType.NotFound:
                store.delete_dir(staged)

    class Batches(DataSource):
        @classmethod
        def name(cls):
            return NAME

        def schema(self):
            raise ValueError("read the folder as Parquet")

        def writer(self, schema, overwrite):
            if overwrite:
                raise ValueError("batches are only appended: a replace is the work of TripTable")
            return Writer(self.options, schema)

    spark.dataSource.register(Batches)
    return NAME


def write_batched(df: DataFrame, path: str, rows: int | None = None, batchsize: int = INSERT_BATCH, most: int = 200) -> None:
    """Appends ``df`` to the folder ``path`` as a load of its own (a folder ``load=<id>``), all of it or nothing.

    One writer per 100,000 of ``rows`` (counted if not given), ``most`` at most; each writes ``batchsize`` rows at a time and holds no more
    than that beside the batch that Spark hands it. ``path`` must be one that the workers reach: a shared folder, or a
    store that Arrow knows.
    """
    register_batches(df.sparkSession)
    writers = jdbc_writers(df.count() if rows is None else rows, most)
    df.coalesce(writers).write.format(NAME).option("path", path).option("batchsize", batchsize).mode("append").save()


def read_batched(spark: SparkSession, path: str) -> DataFrame:
    """All committed loads, without the name of the load."""
    return spark.read.parquet(path).drop("load")
