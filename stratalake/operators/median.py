"""Exact medians per group without gathering any group in one task.

``F.median`` keeps every distinct value of a group in one aggregation buffer, which fails when one group holds a
large share of the rows. Here the rows are read twice, both times combined map-side. The first pass keeps a quantile
sketch of bounded size per group and measure, whose quantiles just below and above the middle are the limits of a narrow
bracket. The second pass counts what lies below the bracket and keeps the distinct values inside it with their
numbers of rows; only those, about ``2 * SPREAD`` of all rows, are sorted.

The sketch may err, the answer may not: the exact counts prove that both middle ranks lie inside the bracket. Its
half-width is about eleven standard errors of the sketch; should a rank lie outside nevertheless, the query fails and
says so instead of giving another value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Items a sketch keeps per level (a standard error of about 0.027 % of the ranks), and the bracket's half-width.
SKETCH = 4096
SPREAD = 0.003
# Zero-based ranks of the two middle values (equal for an odd count).
LOW, HIGH = "(__n - 1) div 2", "__n div 2"


def _counted(
    df: DataFrame, keys: Sequence[str], medians: Mapping[str, Column], counts: Sequence[Column], few_groups: bool, spread: float
) -> DataFrame:
    """``(*keys, __slot, __value, __n, __here, __upto, __c0...)``: the distinct values inside each bracket, a null value
    for all below it, and the rows of each group under slot -1, with ``counts``."""
    sized = F.broadcast if few_groups else (lambda frame: frame)
    quoted = [f"`{key}`" for key in keys]
    slots = range(len(medians))
    values = df.select(
        *quoted,
        *[expr.cast("double").alias(f"__v{i}") for i, expr in enumerate(medians.values())],
        *[expr.alias(f"__c{i}") for i, expr in enumerate(counts)],
    )
    sketches = values.groupBy(*quoted).agg(
        *[F.count(f"__v{i}").alias(f"__n{i}") for i in slots],
        # A sketch skips NaN, which is the greatest value.
        *[F.expr(f"kll_sketch_agg_double(nanvl(__v{i}, double('inf')), {SKETCH})").alias(f"__s{i}") for i in slots],
    )

    def limit(slot: int, quantile: float) -> str:
        return f"CASE WHEN __n{slot} > 0 THEN kll_sketch_get_quantile_double(__s{slot}, {quantile}D) END"

    brackets = sketches.selectExpr(
        *[f"`{key}` AS `__of_{key}`" for key in keys],
        *[f"__n{i}" for i in slots],
        *[f"{limit(i, 0.5 - spread)} AS __from{i}" for i in slots],
        *[f"{limit(i, 0.5 + spread)} AS __to{i}" for i in slots],
    )
    same_group = " AND ".join([f"`{key}` <=> `__of_{key}`" for key in keys]) or "true"
    measures = [
        f"{i}, __n{i}, CASE WHEN __v{i} >= __from{i} THEN __v{i} END, __v{i} IS NOT NULL AND (__v{i} <= __to{i} OR __to{i} = double('inf'))"
        for i in slots
    ]
    stacked = ", ".join([*measures, "-1, 0L, CAST(NULL AS DOUBLE), true"])
    rows = (
        values.join(sized(brackets), F.expr(same_group))
        .selectExpr(
            *quoted,
            *[f"__c{i}" for i in range(len(counts))],
            f"stack({len(medians) + 1}, {stacked}) AS (__slot, __n, __value, __kept)",
        )
        .where("__kept AND (__slot < 0 OR __n > 0)")
        .groupBy(*quoted, "__slot", "__n", "__value")
        .agg(
            F.count(F.lit(1)).alias("__here"),
            *[F.count(F.expr(f"CASE WHEN __slot < 0 THEN __c{i} END")).alias(f"__c{i}") for i in range(len(counts))],
        )
    )
    # One exchange by group serves the running sums and the last aggregate.
    placed = rows.repartition(*quoted) if keys else rows
    window = ", ".join([*quoted, "__slot"])
    upto = f"sum(__here) OVER (PARTITION BY {window} ORDER BY __value NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return placed.selectExpr("*", f"{upto} AS __upto")


def middle_values(
    df: DataFrame, keys: Sequence[str], medians: Mapping[str, Column], few_groups: bool = False, spread: float = SPREAD
) -> DataFrame:
    """``(*keys, __slot, __value, __n, __here, __upto)``: the distinct values left around each group's middle ranks,
    with their number of rows and the number of rows up to them; ``__slot`` numbers ``medians``. A null value stands
    for all values below."""
    found = _counted(df, keys, medians, [], few_groups, spread).where("__slot >= 0")
    return found.select(*[f"`{key}`" for key in keys], "__slot", "__value", "__n", "__here", "__upto")


def grouped_medians(
    df: DataFrame,
    keys: Sequence[str],
    medians: Mapping[str, Column],
    counts: Mapping[str, Column] | None = None,
    few_groups: bool = False,
    spread: float = SPREAD,
) -> DataFrame:
    """One row per group: ``counts`` (non-null counts) followed by exact interpolated ``medians``.

    ``few_groups`` broadcasts the brackets (about 24 bytes per group and measure). Set it only where the data model
    bounds the number of groups, such as labels times years; otherwise Spark decides by size.
    """
    counts = dict(counts or {})

    def value_at(rank: str, slot: int) -> str:
        hit = f"__slot = {slot} AND __upto - __here <= {rank} AND {rank} < __upto"
        return f"max(CASE WHEN {hit} THEN __value END)"

    def median(slot: int) -> str:
        half = f"{value_at(LOW, slot)} * 0.5D + {value_at(HIGH, slot)} * 0.5D"
        outside = "cast(raise_error('a middle rank lies outside its bracket: repeat with a greater spread') AS DOUBLE)"
        size = f"max(CASE WHEN __slot = {slot} THEN __n END)"
        return f"CASE WHEN {size} IS NOT NULL THEN coalesce({half}, {outside}) END"

    counted = _counted(df, keys, medians, list(counts.values()), few_groups, spread)
    return counted.groupBy(*[f"`{key}`" for key in keys]).agg(
        *[F.sum(F.expr(f"CASE WHEN __slot < 0 THEN __c{i} END")).alias(name) for i, name in enumerate(counts)],
        *[F.expr(median(i)).alias(name) for i, name in enumerate(medians)],
    )
