"""Small dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import academic_year, code_prefix, spreadsheet_code
from ..schemas import CONTROL_LABELS, CONTROL_SCHEMA


def label_dim(spark: SparkSession, rows=CONTROL_LABELS, schema=CONTROL_SCHEMA) -> DataFrame:
    """Code and label from literal rows."""
    return spark.createDataFrame(rows, schema)


def distinct_dim(df: DataFrame, columns: dict[str, str], required: str) -> DataFrame:
    """Distinct combinations of the named columns (output name -> source) where ``required`` is known."""
    return (
        df.where(F.col(required).isNotNull())
        .select(*[F.col(source).alias(name) for name, source in columns.items()])
        .distinct()
    )


def year_dim(df: DataFrame, year: str = "year") -> DataFrame:
    years = df.select(F.col(year).cast("smallint").alias("year")).distinct()
    return years.select("year", academic_year(F.col("year")).alias("academic_year")).orderBy("year")


def field_dim(df: DataFrame, code: str, text: str) -> DataFrame:
    """One description per code. A code may carry several texts; the smallest is taken every time."""
    return (
        df.where(F.col(code).isNotNull())
        .groupBy(F.col(code).alias("cip"))
        .agg(F.min(text).alias("field"))
        .select("cip", "field", code_prefix(F.col("cip")).alias("family"))
    )


def family_codes(code_list: DataFrame, code: str = "CIPCode", title: str = "CIPTitle") -> DataFrame:
    """Two-character codes of a spreadsheet-style code list, as ``(code, title)``."""
    cleaned = code_list.select(spreadsheet_code(F.col(code)).alias("code"), F.col(title).alias("title"))
    return cleaned.where(F.length("code") == 2)


def family_dim(families: DataFrame) -> DataFrame:
    return families.select(
        F.col("code").alias("family"), F.rtrim(F.col("title"), F.lit(".")).alias("family_title")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``(failures)``: rows beyond the first per key tuple. Null key parts count as values."""
    extra = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return extra.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("failures"))
