"""Counts of null tokens per column before cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from ..functions import clean_cast, is_token
from ..schemas import MISSING_TOKENS, SUPPRESSED_TOKENS


def null_token_audit(
    bronze: DataFrame,
    columns: Mapping[str, DataType],
    key: str,
    suppressed: Sequence[str] = SUPPRESSED_TOKENS,
    missing: Sequence[str] = MISSING_TOKENS,
) -> DataFrame:
    """Long table ``(key, column, rows, privacy_suppressed, null, cast_failed)`` from one pass over the text.

    ``cast_failed`` counts text that is neither a token nor a value of the column's type, so that
    silver nulls = privacy_suppressed + null + cast_failed.
    """

    ok, is_suppressed, is_missing, is_failed = range(4)

    def state(dtype: DataType):
        def of(text: Column) -> Column:
            found = F.when(text.isNull() | is_token(text, missing), is_missing).when(
                is_token(text, suppressed), is_suppressed
            )
            if not isinstance(dtype, StringType):
                found = found.when(clean_cast(text, dtype, tokens=()).isNull(), is_failed)
            return found.otherwise(ok).cast("tinyint")

        return of

    by_type: dict[DataType, list[str]] = {}
    for name, dtype in columns.items():
        by_type.setdefault(dtype, []).append(name)
    # All states of a row are its signature. Rows are counted by signature first, so that only the distinct signatures
    # are taken apart by column. Columns of one type share one expression: an expression per column would compile to
    # a method longer than the JVM translates to machine code.
    states = F.concat(*[F.transform(F.array(*names), state(dtype)) for dtype, names in by_type.items()])
    signatures = bronze.select(key, states.alias("states")).groupBy(key, "states").agg(F.count(F.lit(1)).alias("n"))
    counts = (
        signatures.select(key, "n", F.posexplode("states").alias("place", "state"))
        .groupBy(key, "place", "state")
        .agg(F.sum("n").alias("n"))
    )

    def counted(code: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("state") == code, F.col("n"))), F.lit(0))

    names = F.array(*[F.lit(name) for names in by_type.values() for name in names])
    return (
        counts.groupBy(key, "place")
        .agg(
            F.sum("n").alias("rows"),
            counted(is_suppressed).alias("privacy_suppressed"),
            counted(is_missing).alias("null"),
            counted(is_failed).alias("cast_failed"),
        )
        .select(
            key,
            names[F.col("place")].alias("column"),
            "rows",
            "privacy_suppressed",
            "null",
            "cast_failed",
        )
    )


def audit_totals(audit: DataFrame) -> DataFrame:
    """The audit summed over all files, worst columns first."""
    return (
        audit.groupBy("column")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("privacy_suppressed").alias("privacy_suppressed"),
            F.sum("null").alias("missing"),
        )
        .orderBy(F.desc("privacy_suppressed"), F.desc("missing"), F.asc("column"))
    )
