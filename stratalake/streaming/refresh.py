"""Incremental refresh of silver: only years with new files are rebuilt."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..plans.silver import to_silver
from ..sources import (
    current_version,
    list_files,
    publish,
    read_bronze,
    remove_folder,
    shared_folder,
    write_partitioned,
)


def datasets(spark: SparkSession, folder: str, key_pattern: str, glob: str | None = None) -> DataFrame:
    """``(key, dataset)`` under ``folder``: each path up to the part that carries the key.

    That is the file itself for ``MERGED1998_PP.csv`` and the folder for ``year=1998/part-0.csv``.
    """
    path = F.col("path")
    return (
        list_files(spark, folder, glob)
        .select(
            F.regexp_extract(path, key_pattern, 1).alias("key"),
            F.regexp_extract(path, f"^(.*?{key_pattern}[^/]*)", 1).alias("dataset"),
        )
        .where(F.col("key") != "")
        .distinct()
    )


def refresh_years(
    spark: SparkSession,
    folder: str,
    columns: Mapping[str, DataType],
    key: str,
    key_pattern: str,
    silver_path: str,
    changed: Sequence[str],
    glob: str | None = None,
) -> None:
    """Rebuild the ``changed`` partitions from all files of those years; other partitions stay as they are.

    Running it again gives the same rows, so a job that died half way is simply repeated.
    """
    # File names only, a few per year.
    found = datasets(spark, folder, key_pattern, glob).where(F.col("key").isin(*changed)).collect()
    if not found:
        return
    paths = sorted(row["dataset"] for row in found)
    bronze = read_bronze(spark, paths, key, key_pattern, columns=list(columns))
    silver = to_silver(bronze, columns, key)
    write_partitioned(silver, silver_path, key, incremental=True, compact=True)


MANIFEST = "path string, length long, modified timestamp, key string"


def manifest_of(spark: SparkSession, folder: str, key_pattern: str, glob: str | None = None) -> DataFrame:
    """``(path, length, modified, key)`` of the files under ``folder`` that carry a key; contents are not read."""
    return (
        list_files(spark, folder, glob)
        .select("path", "length", F.col("modificationTime").alias("modified"), F.regexp_extract("path", key_pattern, 1).alias("key"))
        .where(F.col("key") != "")
    )


def manifest_changes(now: DataFrame, before: DataFrame) -> DataFrame:
    """``(path, key, change)``: files that are new, changed in length or time, or deleted since ``before``."""
    old = before.select("path", F.col("length").alias("old_length"), F.col("modified").alias("old_modified"), F.col("key").alias("old_key"))
    same = (F.col("length") == F.col("old_length")) & (F.col("modified") == F.col("old_modified"))
    change = (
        F.when(F.col("old_key").isNull(), "new").when(F.col("key").isNull(), "deleted").when(~same, "changed")
    )
    found = now.join(old, "path", "full").select("path", F.coalesce("key", "old_key").alias("key"), change.alias("change"))
    return found.where(F.col("change").isNotNull())


def refresh_changed(
    spark: SparkSession,
    folder: str,
    columns: Mapping[str, DataType],
    key: str,
    key_pattern: str,
    silver_path: str,
    manifest_path: str,
    glob: str | None = None,
) -> dict[str, list[str]]:
    """Bring silver up to date with the files as they are, and say which keys were rebuilt and which removed.

    The files are compared with the manifest of the last run (none: all are new). Years with a new, changed or deleted
    file are rebuilt from the files they have now; years without any file lose their partition. The manifest is
    published last, so a run that died is repeated in full and gives the same rows.
    """
    now = manifest_of(spark, folder, key_pattern, glob)
    # The listing is written first: what is compared and what is remembered must be the same files.
    listed = shared_folder(spark, "manifest")
    now.write.parquet(listed)
    now = spark.read.schema(MANIFEST).parquet(listed)
    known = current_version(spark, manifest_path)
    before = spark.read.schema(MANIFEST).parquet(known) if known != manifest_path else spark.createDataFrame([], MANIFEST)
    # One value per year or cohort: bounded by the calendar.
    changed = [row["key"] for row in manifest_changes(now, before).select("key").distinct().collect()]
    left = {row["key"] for row in now.select("key").distinct().collect()}
    rebuilt, removed = sorted(k for k in changed if k in left), sorted(k for k in changed if k not in left)
    target = current_version(spark, silver_path)
    if rebuilt:
        refresh_years(spark, folder, columns, key, key_pattern, target, rebuilt, glob)
    for gone in removed:
        remove_folder(spark, f"{target}/{key}={gone}")
    if changed:
        spark.catalog.refreshByPath(target)
    if changed or known == manifest_path:
        publish(spark, manifest_path, lambda version: now.coalesce(1).write.parquet(version))
    remove_folder(spark, listed)
    return {"rebuilt": rebuilt, "removed": removed}


def stream_refresh(
    spark: SparkSession,
    folder: str,
    columns: Mapping[str, DataType],
    key: str,
    key_pattern: str,
    silver_path: str,
    checkpoint: str,
    glob: str | None = None,
) -> None:
    """Process the files that arrived since the last run, then stop (``availableNow``).

    A batch only says which years got files; those years are rebuilt from all their files. A batch that Spark
    repeats after a failure therefore neither drops nor doubles rows, and a year may arrive in several batches.
    """
    # Only paths are asked for, so no file's content is read before its year is rebuilt.
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", True)
    )
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    arrivals = reader.load(folder).select(F.regexp_extract("path", key_pattern, 1).alias("key"))

    def rebuild(batch: DataFrame, _batch_id: int) -> None:
        # One value per year or cohort: bounded by the calendar.
        changed = [row["key"] for row in batch.where(F.col("key") != "").distinct().collect()]
        if changed:
            refresh_years(
                batch.sparkSession, folder, columns, key, key_pattern, silver_path, changed, glob
            )

    query = (
        arrivals.writeStream.foreachBatch(rebuild)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
