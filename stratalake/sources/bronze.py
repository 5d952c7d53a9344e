"""Text sources: yearly CSV files, code lists and file listings."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..schemas import text_schema


def csv_reader(spark: SparkSession, multi_line: bool = False):
    """Header row, text only, ``""`` as the escaped quote and backslash as plain text.

    ``multi_line`` is for files with line breaks inside quotes; it gives up splitting a file between tasks.
    """
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
    )


def header_of(spark: SparkSession, path: str, multi_line: bool = False) -> tuple[str, ...]:
    """Column names of one dataset (a file, or a folder of part files written together)."""
    return tuple(csv_reader(spark, multi_line).csv(path).columns)


def _first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a task's input. The task ends there, whatever is left to read."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def first_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, str | None]:
    """The first line of each of ``paths``, of a folder that of its first file; none of empty files and patterns.

    One job reads all files: a task per file, which stops after its first rows.
    """
    whole = str(2**45)  # larger than any file, and its sum over all files still fits a long
    settings = {"spark.sql.files.maxPartitionBytes": whole, "spark.sql.files.openCostInBytes": whole}
    before = {name: spark.conf.get(name) for name in settings}
    text = spark.read.option("recursiveFileLookup", True).text(list(paths))
    text = text.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        rows = text.mapInArrow(_first_rows, "file string, line string").collect()  # a line per file
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    found: dict[str, str | None] = dict.fromkeys(paths)
    datasets = {_place(path): path for path in paths}
    for file, line in sorted(rows, reverse=True):
        place = _place(unquote(file))  # Spark writes the paths of files in their encoded form
        while place and place not in datasets:
            place = place.rpartition("/")[0]
        if place:
            found[datasets[place]] = line
    return found


def _place(path: str) -> str:
    """A path without its scheme and closing slash."""
    return re.sub("^[a-zA-Z][a-zA-Z0-9+.-]*:/+", "/", path).rstrip("/")


def layouts_of(
    spark: SparkSession, paths: Sequence[str], multi_line: bool = False
) -> dict[tuple[str, ...], list[str]]:
    """Datasets grouped by identical header.

    One job reads the first lines of all datasets; names are parsed once per distinct line. A header that may itself
    span lines, or that of a pattern of paths, is parsed per dataset.
    """
    lines = dict.fromkeys(paths) if multi_line else first_lines(spark, paths)
    groups: dict[tuple, list[str]] = {}
    for path, line in lines.items():
        groups.setdefault((line, path if line is None else None), []).append(path)
    layouts: dict[tuple[str, ...], list[str]] = {}
    for members in groups.values():
        layouts.setdefault(header_of(spark, members[0], multi_line), []).extend(members)
    return layouts


def read_bronze(
    spark: SparkSession,
    paths: Sequence[str],
    key: str | None = None,
    key_pattern: str | None = None,
    columns: Sequence[str] | None = None,
    by_name: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """All ``paths`` as one text table, matched by column name, with ``key`` taken from the file path.

    Spark binds several CSV files of one read by position, so files are grouped by identical header: one scan per
    distinct header, joined by name. Header order changes rarely (once per yearly layout), which keeps the plan
    small whatever the number of files. ``columns`` keeps only those columns, absent ones as null. A part file
    whose header differs from its dataset's fails the read; it is never bound to the wrong columns.
    """
    paths = list(paths)
    if by_name:
        layouts = layouts_of(spark, paths, multi_line)
    else:
        layouts = {header_of(spark, paths[0], multi_line): paths}

    frames = []
    for header, members in layouts.items():
        # Header checks need every column's place, so they look at the names of the full layout.
        scan = (
            csv_reader(spark, multi_line)
            .option("enforceSchema", False)
            .schema(text_schema(list(header)))
            .csv(members)
        )
        wanted = list(header) if columns is None else list(columns)
        present = {name.lower() for name in header}
        picked = [
            F.col(f"`{name}`") if name.lower() in present else F.lit(None).cast("string").alias(name)
            for name in wanted
        ]
        if key is not None:
            found = F.regexp_extract(F.col("_metadata.file_path"), key_pattern, 1)
            picked.insert(0, found.alias(key))
        frames.append(scan.select(*picked))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_code_list(spark: SparkSession, path: str) -> DataFrame:
    return csv_reader(spark).csv(path)


def file_widths(spark: SparkSession, paths: Sequence[str], multi_line: bool = False) -> DataFrame:
    """``(file, columns)``: the number of header columns of each dataset."""
    layouts = layouts_of(spark, paths, multi_line)
    rows = [(path, len(header)) for header, members in layouts.items() for path in members]
    schema = StructType([StructField("file", StringType()), StructField("columns", IntegerType())])
    return spark.createDataFrame(rows, schema)


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(path, length, modificationTime)`` of all files under ``path``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime")


def layer_contents(spark: SparkSession, layers: dict[str, tuple[str, str]]) -> DataFrame:
    """``(layer, rows, partitions)`` per layer, given ``layer -> (folder, file name glob)``: data rows of its files
    (of Parquet files as their footers say) and distinct folders that hold them."""
    counted = []
    for layer, (folder, glob) in layers.items():
        named = F.lit(layer).alias("layer")
        text = glob.endswith(".csv")
        reader = csv_reader(spark) if text else spark.read
        # No column is read, so a name will do for the schema.
        files = reader.schema("any string").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
        rows = files.csv(folder) if text else files.parquet(folder)
        folders = list_files(spark, folder, glob).select(F.regexp_extract("path", "^(.*)/", 1).alias("folder"))
        counted.append(
            rows.agg(F.count(F.lit(1)).alias("rows")).select(named, "rows", F.lit(0).cast("long").alias("partitions"))
        )
        counted.append(
            folders.agg(F.countDistinct("folder").alias("partitions")).select(named, F.lit(0).cast("long").alias("rows"), "partitions")
        )
    every = reduce(DataFrame.unionByName, counted)
    return every.groupBy("layer").agg(F.sum("rows").alias("rows"), F.sum("partitions").alias("partitions"))


def layer_sizes(spark: SparkSession, layers: dict[str, tuple[str, str]]) -> DataFrame:
    """``(layer, files, bytes)`` per layer, given ``layer -> (folder, file name glob)``."""
    listed = [
        list_files(spark, folder, glob).select(F.lit(layer).alias("layer"), "length")
        for layer, (folder, glob) in layers.items()
    ]
    return (
        reduce(DataFrame.unionByName, listed)
        .groupBy("layer")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )
