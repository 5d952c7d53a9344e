"""Wide/long reshaping, extremes and set differences over result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def share_matrix(wide: DataFrame, key: str, measures: Sequence[str], whole: str) -> DataFrame:
    """``(key, measure, share)`` of ``measure / whole``; a share of zero means "absent" and becomes null."""
    shares = wide.select(
        key,
        *[
            F.nullif(F.try_divide(F.col(name).cast("double"), F.col(whole)), F.lit(0.0)).alias(name)
            for name in measures
        ],
    )
    return shares.unpivot(key, list(measures), "measure", "share")


def pivot_sum(long: DataFrame, key: str, category: str, values: Sequence[str], measure: str) -> DataFrame:
    """One column per listed category value. The list is given, so no job runs to find it."""
    return long.groupBy(key).pivot(category, list(values)).agg(F.sum(measure))


def peak(df: DataFrame, at: str, measure: str) -> DataFrame:
    """``(at, measure)`` of the greatest measure; the earliest ``at`` wins a tie."""
    best = F.max(F.struct(F.col(measure).alias("m"), (-F.col(at)).alias("a")))
    known = df.where(F.col(measure).isNotNull())
    return known.agg(best.alias("best")).select(
        (-F.col("best.a")).alias(at), F.col("best.m").alias(measure)
    )


# Groups whose ends are found apart before the last ranking, so that no task ranks all rows.
END_GROUPS = 64


def top_bottom(df: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    """First and last ``n`` rows of the ranking by descending ``by``, with ``place`` top or bottom.

    As with the head and tail of a list, a row stands in both ends when there are fewer than ``2 * n`` rows. The input
    is planned and read once: both ends of each of a number of groups, then both ends of what is left.
    """
    order = {"__top": [F.col(by).desc_nulls_last(), F.asc(tie)], "__bottom": [F.col(by).asc_nulls_first(), F.desc(tie)]}

    def ends(rows: DataFrame, group) -> DataFrame:
        places = {name: F.row_number().over(Window.partitionBy(group).orderBy(*columns)) for name, columns in order.items()}
        return rows.withColumns(places).where((F.col("__top") <= n) | (F.col("__bottom") <= n))

    groups = df.withColumn("__group", F.pmod(F.xxhash64(by, tie), F.lit(END_GROUPS)))
    both = ends(ends(groups, F.col("__group")), F.lit(0))
    places = F.filter(
        F.array(F.when(F.col("__top") <= n, "top"), F.when(F.col("__bottom") <= n, "bottom")), lambda place: place.isNotNull()
    )
    rank = F.when(F.col("place") == "top", F.col("__top")).otherwise(F.col("__bottom"))
    return both.withColumn("place", F.explode(places)).orderBy(F.desc("place"), rank).drop("__group", *order)


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row ``(differences)``: rows found on one side only, repeats included."""
    only_left = left.exceptAll(right).agg(F.count(F.lit(1)).alias("n"))
    only_right = right.exceptAll(left).agg(F.count(F.lit(1)).alias("n"))
    return only_left.unionByName(only_right).agg(F.sum("n").alias("differences"))


def layers_agree(layers: dict[str, DataFrame]) -> DataFrame:
    """``(pair, differences)`` between each layer's result and the next one's; all zero when they agree."""
    names = list(layers)
    lines = [
        differences(layers[a], layers[b]).select(F.lit(f"{a}={b}").alias("pair"), "differences")
        for a, b in zip(names, names[1:])
    ]
    report = lines[0]
    for line in lines[1:]:
        report = report.unionByName(line)
    return report
