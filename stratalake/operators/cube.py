"""Cube over categories, aggregated once at the finest grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cube_agg(
    df: DataFrame, dims: Sequence[str], sums: Mapping[str, str], count_name: str
) -> DataFrame:
    """All ``2 ** len(dims)`` subtotal levels with ``grouping_id`` (first dimension is the high bit).

    Counts and sums add up across levels, so the detail rows are grouped once and the cube expands only the
    grouped rows. A cube over the detail itself would send every row through all levels.
    """
    finest = df.groupBy(*dims).agg(
        F.count(F.lit(1)).alias(count_name),
        *[F.sum(source).alias(name) for name, source in sums.items()],
    )
    measures = [count_name, *sums]
    return (
        finest.cube(*dims)
        .agg(
            F.grouping_id(*dims).cast("int").alias("grouping_id"),
            *[F.sum(name).alias(name) for name in measures],
        )
        .select(*dims, "grouping_id", *measures)
    )


def grouping_of(dims: Sequence[str], keep: Sequence[str]) -> int:
    """The ``grouping_id`` of the level that keeps exactly ``keep``."""
    unknown = set(keep) - set(dims)
    if unknown:
        raise ValueError(f"not a cube dimension: {sorted(unknown)}")
    return sum(1 << place for place, dim in enumerate(reversed(list(dims))) if dim not in keep)


def cube_level(cube: DataFrame, dims: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Rows of one level. Chosen by ``grouping_id``: a null dimension value may also be a real null."""
    return cube.where(F.col("grouping_id") == grouping_of(dims, keep))
