"""Lake storage: the shared folder, partitioned Parquet, result files."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Longest Parquet file written by one task, in rows: a year that holds most of the data becomes many files.
MAX_ROWS_PER_FILE = 20_000_000


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name that every executor can reach, under the session's checkpoint folder.

    Only a local session without that setting gets a temporary folder on this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="stratalake-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder this application wrote, on whatever file system it is."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


# The file in a published folder that names its current version, and how many versions are kept for readers.
POINTER = "_current"
KEPT_VERSIONS = 2


def current_version(spark: SparkSession, folder: str) -> str:
    """The folder that holds the current version of ``folder``: itself if nothing was published there."""
    jvm = spark.sparkContext._jvm
    pointer = jvm.org.apache.hadoop.fs.Path(f"{folder}/{POINTER}")
    files = pointer.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(pointer):
        return folder
    stream = files.open(pointer)
    try:
        return f"{folder}/{jvm.org.apache.commons.io.IOUtils.toString(stream, 'UTF-8')}"
    finally:
        stream.close()


def publish(spark: SparkSession, folder: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a new version of ``folder``, then make it the current one by replacing one small file.

    Until then, and for good if ``write`` fails, readers get the version before, whose files stay: the last
    ``KEPT_VERSIONS`` are kept, older ones removed. The replacement is one rename of the file system.
    """
    jvm, settings = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(settings)
    before = current_version(spark, folder)
    name = f"version-{uuid.uuid4().hex}"
    try:
        write(f"{folder}/{name}")
    except BaseException:
        files.delete(path(f"{folder}/{name}"), True)
        raise
    written = files.create(path(f"{folder}/{POINTER}-{name}"))
    written.write(bytearray(name.encode()))
    written.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), settings)
    context.rename(path(f"{folder}/{POINTER}-{name}"), path(f"{folder}/{POINTER}"), overwrite)
    spark.catalog.refreshByPath(folder)
    spared = {name, before.rsplit("/", 1)[-1]}
    others = [s for s in files.listStatus(path(folder)) if s.getPath().getName().startswith("version-")]
    others = sorted((s for s in others if s.getPath().getName() not in spared), key=lambda s: -s.getModificationTime())
    for old in others[max(0, KEPT_VERSIONS - len(spared)) :]:
        files.delete(old.getPath(), True)


def write_partitioned(
    df: DataFrame, path: str, key: str, incremental: bool = False, compact: bool = False
) -> None:
    """Parquet under ``key=value`` folders; each task writes what it read, without a shuffle.

    ``incremental`` replaces only the partitions present in ``df``. ``compact`` is for wide text cut to a few
    columns, where a task's output is about a hundredth of its input and files would be tiny: the narrow rows are
    exchanged once, adaptive execution merges small partitions and splits a dominant ``key`` over several writers.
    """
    out = df.hint("rebalance", key) if compact else df
    mode = "dynamic" if incremental else "static"
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .partitionBy(key)
        .parquet(path)
    )


def read_lake(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    """Parquet folder (its current version, if it is published), partition keys included; optionally also a view."""
    df = spark.read.parquet(current_version(spark, path))
    if view is not None:
        df.createOrReplaceTempView(view)
    return df


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with header. ``single`` is for marts, whose row count the model bounds."""
    out = df.coalesce(1) if single else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema) -> DataFrame:
    """A result file read back with its declared types."""
    return spark.read.option("header", True).option("escape", '"').schema(schema).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Full rebuild of every table as a Parquet folder, published together: all of them or none."""
    spark = next(iter(tables.values())).sparkSession

    def write(version: str) -> None:
        for name, df in tables.items():
            df.write.parquet(f"{version}/{name}")

    publish(spark, folder, write)


def read_tables(spark: SparkSession, names, folder: str) -> dict[str, DataFrame]:
    version = current_version(spark, folder)
    return {name: spark.read.parquet(f"{version}/{name}") for name in names}


def save_catalog_tables(
    tables: dict[str, DataFrame], folder: str, buckets: int = 0, bucket_key: str = "unitid"
) -> None:
    """Full rebuild as catalog tables under ``folder``. ``buckets`` co-locates all tables with ``bucket_key``.

    With equal buckets a join or window by that key reads its bucket and needs no exchange. Rows are sent to
    their bucket before the write, so a bucket is one file and not one per task.
    """
    for name, df in tables.items():
        bucketed = buckets and bucket_key in df.columns
        out = df.repartition(buckets, bucket_key) if bucketed else df
        writer = out.write.mode("overwrite").format("parquet").option("path", f"{folder}/{name}")
        if bucketed:
            writer = writer.bucketBy(buckets, bucket_key).sortBy(bucket_key)
        writer.saveAsTable(name)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(name, value)``: one count per table, in one job."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("name"), "value")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)
