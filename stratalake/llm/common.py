"""Helpers shared by the operators: stored intermediate tables, bounded Arrow batches, connected components."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.lake import remove_folder, shared_folder

# Arrow batches sent to Python end at whichever comes first: very long texts must fit beside others in a worker.
ROWS_PER_BATCH = 10_000
BYTES_PER_BATCH = 16 << 20


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="py-files-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the folder all executors share and read back: cuts lineage, survives lost executors."""
    return stored_at(df, purpose)[1]


def stored_at(df: DataFrame, purpose: str) -> tuple[str, DataFrame]:
    """``stored`` with the table's path, for ``consumed``."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


def consumed(spark: SparkSession, path: str) -> None:
    """Remove a table of ``stored_at`` of which all that is read later has been stored."""
    remove_folder(spark, path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a finished query go at once, not when the driver next collects garbage.

    For steps that write their result: what is read later is the written table.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def map_batches(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` whose input batches are bounded in rows and bytes."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def utf8(column: pa.Array) -> Iterable[bytes]:
    """The texts of an Arrow string column as UTF-8 bytes; null is empty."""
    return (value.as_py() or b"" for value in column.cast(pa.binary()))


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows_each: int) -> Iterator[pa.Table]:
    """Re-cut batches sorted by ``key`` into tables of about ``rows_each`` rows that never split a key."""

    def parts(table: pa.Table, keys: np.ndarray) -> Iterator[pa.Table]:
        start = 0
        while start < table.num_rows:
            last = min(start + rows_each, table.num_rows) - 1
            end = int(keys.searchsorted(keys[last], side="right"))
            yield table.slice(start, end - start)
            start = end

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < rows_each:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column(key).to_numpy()
        cut = int(keys.searchsorted(keys[-1]))
        yield from parts(table.slice(0, cut), keys[:cut])
        held = table.slice(cut).to_batches()
        rows = table.num_rows - cut
    if rows:
        table = pa.Table.from_batches(held).combine_chunks()
        yield from parts(table, table.column(key).to_numpy())


def numbered(df: DataFrame, order: list[str], groups: list[str] | None = None) -> DataFrame:
    """``df`` with ``__place``, each row's place (from 0) in its group by ascending ``order``, and ``__size``, the rows
    of the group. Nulls go first; rows equal in ``order`` are placed as they stand, so ``df`` should be a stored table.

    Rows are dealt by ranges of group and order, then placed in their range; a place in the group adds the rows of
    earlier ranges. Only one line per range and group is ever summed in one task, so a group may hold all rows.
    """
    groups = groups or []
    keys = [f"`{name}`" for name in [*groups, *order]]
    dealt = df.withColumn("__stood", F.monotonically_increasing_id()).repartitionByRange(*keys, "__stood")
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stored(
        dealt.sortWithinPartitions(*keys, "__stood").withColumns({"__range": F.spark_partition_id(), "__within": within}),
        "placed",
    )
    by_group = Window.partitionBy(*[f"`{name}`" for name in groups])
    earlier = by_group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        placed.groupBy("__range", *groups)
        .agg(F.min("__within").alias("__first"), F.count(F.lit(1)).alias("__rows"))
        .withColumns({"__before": F.coalesce(F.sum("__rows").over(earlier), F.lit(0)), "__size": F.sum("__rows").over(by_group)})
        .selectExpr("__range AS __range_of", "__before - __first AS __shift", "__size", *[f"`{g}` AS `__of_{g}`" for g in groups])
    )
    same = " AND ".join(["__range = __range_of", *[f"`{name}` <=> `__of_{name}`" for name in groups]])
    return placed.join(stored(ranges, "ranges"), F.expr(same)).select(
        *[f"`{name}`" for name in df.columns], (F.col("__within") + F.col("__shift")).alias("__place"), "__size"
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the links ``(a long, b long)``: ``(node, root)`` with the least node as root.

    Alternates two steps until nothing changes: every node hands its larger neighbours to the least neighbour, then
    its smaller ones. The number of rounds grows with the logarithm of the longest path. Each round is written to the
    shared folder; a node with very many links is only ever aggregated or split by the runtime's skew handling.
    Nodes without links are not returned.
    """
    links = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(),
        "links",
    )
    before = _signature(links)
    while before[0]:
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        links = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stored(moved.union(least.select("u", F.col("m").alias("v"))).where("u > v").distinct(), "links")
        after = _signature(links)
        if after == before:
            break
        before = after
    leaves = links.groupBy("u").agg(F.min("v").alias("v"))
    return leaves.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        leaves.select("v", "v").distinct()
    )


def _signature(links: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v")
    row = links.agg(
        F.count("*"), F.sum(mixed.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(mixed, 32))
    ).first()
    return tuple(row)
