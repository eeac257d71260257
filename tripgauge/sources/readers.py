"""Trip readers: CSV (header), Parquet, and a partitioned JDBC read."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from tripgauge.operators.columns import normalize_columns
from tripgauge.operators.ranking import row_numbers
from tripgauge.session import materialize


#: Files up to this size are read whole for their header, many to a task; of a larger file only the first lines are.
SMALL_FILE = 1 << 20


def _one_file_a_task(spark: SparkSession):
    """Settings under which a scan gives every file a task of its own, whole."""
    whole = str(1 << 50)
    return {"spark.sql.files.maxPartitionBytes": whole, "spark.sql.files.openCostInBytes": whole,
            "spark.sql.execution.arrow.maxRecordsPerBatch": "16"}


def csv_headers(spark: SparkSession, path: str | list[str], small: int = SMALL_FILE) -> DataFrame:
    """(path, header): the first line that isn't blank of every file, read on the executors by two scans, whatever the number of files.

    Small files are read whole, packed many to a task, and reduced to their first line inside it. Each larger file
    is a task that stops after the first lines, so its other bytes are never read. Files without such a line give no row.
    """
    lines = spark.read.text(path)
    # The metadata column holds an encoded URI; readers take the plain path.
    plain = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    lines = lines.select(plain.alias("path"), F.col("_metadata.file_size").alias("size"),
                         F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("header"))
    shown = F.trim("header") != ""
    packed = lines.where(shown & (F.col("size") <= small)).withColumn("at", F.monotonically_increasing_id()).groupBy("path").agg(
        F.min_by("header", F.struct("start", "at")).alias("header"))

    def first(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    alone = lines.where(shown & (F.col("size") > small)).select("path", "header").mapInArrow(first, "path string, header string")
    with _settings(spark, _one_file_a_task(spark)):  # the scan is planned, and run, under these
        alone = materialize(alone, "csv_headers")
    return packed.unionByName(alone)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_trips(spark: SparkSession, path: str, fmt: str = "csv",
               schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header row (explicit schema: one pass; none: inferred, an extra pass) or Parquet.

    CSV columns go by their names: files are read per distinct header, and
    where headers differ the standard spellings are normalised before the
    parts are united by name (columns that a file lacks are null). ``schema``
    gives types by name. Inferred date and time columns stay text, so the
    session's time zone never touches them. Headers are found by
    ``csv_headers``: the number of jobs grows with the distinct headers, not
    the files; a folder with one header is read as it is, without a list of files.
    Files without any line that isn't blank hold no trips.
    """
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    reader = spark.read.option("header", True)
    headers = materialize(csv_headers(spark, path), "csv_headers")
    groups = headers.groupBy("header").agg(F.min("path").alias("one")).orderBy("one").collect()  # a row per distinct header
    # How Spark names the columns of a header (quotes, blanks, repeats) is left to its reader, once a header.
    names = {r["header"]: tuple(reader.csv(r["one"]).columns) for r in groups}
    by_header: dict[tuple, list[str]] = {}
    for r in groups:
        by_header.setdefault(names[r["header"]], []).append(r["header"])
    typed = {}
    if schema is not None:
        wanted = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
        typed = {f.name: f.dataType for f in wanted.fields}
        if not by_header:
            return spark.createDataFrame([], wanted)
    parts = []
    for header, spellings in by_header.items():
        if len(by_header) == 1:
            some = path
        else:  # Spark's own file index holds the files' names on the driver as well
            some = [r["path"] for r in headers.where(F.col("header").isin(spellings)).select("path").orderBy("path").collect()]
        types = typed or {f.name: f.dataType for f in spark.read.option("header", True).option("inferSchema", True).csv(some).schema.fields}
        own = StructType([StructField(c, _untimed(types.get(c, StringType())) if schema is None else types.get(c, StringType())) for c in header])
        parts.append(spark.read.option("header", True).schema(own).csv(some))
    if not parts:
        return spark.createDataFrame([], StructType([]))
    if len(parts) == 1:
        return parts[0]
    out = normalize_columns(parts[0])
    for part in parts[1:]:
        out = out.unionByName(normalize_columns(part), allowMissingColumns=True)
    return out


def _untimed(kind):
    return StringType() if isinstance(kind, (DateType, TimestampType, TimestampNTZType)) else kind


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int,
              partitions: int, **options) -> DataFrame:
    """Parallel JDBC read: ``partitions`` range queries over the numeric ``key``.

    ``table`` may be a table name or a parenthesised subquery with an alias,
    so filters and projections still run in the database.
    """
    return (spark.read.format("jdbc")
            .option("url", url).option("dbtable", table)
            .option("partitionColumn", key).option("lowerBound", lower).option("upperBound", upper)
            .option("numPartitions", partitions)
            .options(**options).load())


def sample_trips(df: DataFrame, n: int, seed: int = 42, key: str = "trip_id", hashed: Column | None = None,
                 span: tuple[int, int] = (-(1 << 63), (1 << 63) - 1)) -> DataFrame:
    """Reproducible fixed-size sample: the n rows with the smallest hash of ``key`` (ties by ``key``).

    ``hashed`` replaces the seeded 64-bit hash; ``span`` is the range of its
    values. A threshold a little above the n-th hash lets few more than n rows
    into a distributed numbering, so no task ever holds the sample, and the
    result never depends on partitioning or row order.
    """
    h = F.xxhash64(F.col(key), F.lit(seed)) if hashed is None else hashed
    rows = df.withColumn("_h", h)
    total = df.count()
    share = min(1.0, (n + 6 * n ** 0.5 + 10) / max(total, 1))
    some = rows.where(F.col("_h") <= F.lit(int(span[0] + share * (span[1] - span[0]))))
    if share < 1 and some.count() < n:  # an uneven hash
        some = rows
    return row_numbers(some, ["_h", key], "_rank", name="sample").where(F.col("_rank") <= n).drop("_h", "_rank")


def first_n(df: DataFrame, n: int) -> DataFrame:
    """The first n rows as read, in as many tasks as hold them (``limit`` would bring all n into one).

    One scan counts the rows of each partition; the n-th row's place is then a bound on the row number that every
    partition filters by. ``df`` must read files, so that both scans number the rows alike.
    """
    numbered = df.withColumn("_place", F.monotonically_increasing_id())
    sizes = numbered.groupBy(F.shiftright("_place", 33).alias("part")).count().orderBy("part").collect()  # a row per partition
    for row in sizes:
        if n <= row["count"]:
            return numbered.where(F.col("_place") < (row["part"] << 33) + n).drop("_place")
        n -= row["count"]
    return df
