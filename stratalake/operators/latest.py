"""Latest known value per key and latest row per key, both as map-side combinable aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, ShortType


def latest_value(value: Column, order: Column) -> Column:
    """Aggregate: the non-null ``value`` with the greatest ``order``.

    Rows without a value never win (a bare ``max_by`` would return their null); equal orders fall back to the
    greater value, so the result does not depend on row order.
    """
    candidate = F.struct(order.alias("order"), value.alias("value"))
    return F.max(F.when(value.isNotNull(), candidate))["value"]


def latest_integer(value: Column, order: Column) -> Column:
    """``latest_value`` for integers of up to 32 bits under an order of up to 31.

    Order and value share one long, whose maximum a hash aggregate updates in place; a struct would be sorted.
    """
    half = 1 << 31
    packed = F.shiftleft(order.cast("long"), 32) + value.cast("long") + F.lit(half)
    top = F.max(F.when(value.isNotNull(), packed))
    return (top.bitwiseAND(F.lit((1 << 32) - 1)) - F.lit(half)).cast("int")


def latest_nonnull(
    df: DataFrame, key: str, order: str, attributes: Mapping[str, str], first: str, last: str
) -> DataFrame:
    """One row per ``key``: every attribute's latest known value plus the first and last ``order`` seen.

    ``attributes`` maps output name to source column. A key with very many rows shrinks to one row per task
    before the shuffle. Integers are packed with their order; any other type makes the aggregate sort.
    """
    small = (ByteType, ShortType, IntegerType)

    def latest(source: str) -> Column:
        kind = df.schema[source].dataType
        if isinstance(kind, small) and isinstance(df.schema[order].dataType, small):
            return latest_integer(F.col(source), F.col(order)).cast(kind)
        return latest_value(F.col(source), F.col(order))

    return df.groupBy(key).agg(
        *[latest(source).alias(name) for name, source in attributes.items()],
        F.min(order).alias(first),
        F.max(order).alias(last),
    )


def latest_row(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[str],
    columns: Sequence[str],
    totals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The row with the greatest ``order`` tuple per key, and ``totals`` over all rows of the key.

    ``order`` must be unique within a key.

    Done with ``max(struct)`` and not ``row_number``: all rows of a hot key never meet in one window.
    """
    top = F.max(F.struct(*order, *columns)).alias("__top")
    totals = dict(totals or {})
    return df.groupBy(*keys).agg(top, *[total.alias(name) for name, total in totals.items()]).select(
        *[F.col(key) if isinstance(key, str) else key for key in keys],
        *[F.col(f"__top.{name}").alias(name) for name in (*order, *columns)],
        *totals,
    )
