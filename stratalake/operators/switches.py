"""Changes of a category from one of an entity's rows to its next."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def category_changes(fact: DataFrame, key: str, order: str, category: str) -> DataFrame:
    """``(key, order, category, prev, prev2)`` for rows whose category differs from the entity's row before.

    Rows without a category are left out first, so a gap does not break a run. The fact holds one row per
    key and ``order``, which bounds a window by the number of years. Both lags share one exchange and sort.
    """
    history = Window.partitionBy(key).orderBy(order)
    return (
        fact.where(F.col(category).isNotNull())
        .select(key, order, category)
        .withColumn("prev", F.lag(category).over(history))
        .withColumn("prev2", F.lag(category, 2).over(history))
        .where(F.col(category) != F.col("prev"))
    )


def switches(
    fact: DataFrame, key: str, order: str, category: str, labels: DataFrame, total: str = "All"
) -> DataFrame:
    """Per from/to label: switches, entities, switches that undo the one before; plus one total row.

    ``labels`` is a small table ``(code, label)``. The total counts each entity once. Its distinct count costs no
    extra shuffle: the rows already sit together by ``key``, so an entity's first label pair is marked there and
    the marks are summed.
    """
    code = F.broadcast(labels)
    origin = code.select(F.col(category).alias("prev"), F.col("label").alias("from_label"))
    target = code.select(F.col(category), F.col("label").alias("to_label"))
    pairs = (
        category_changes(fact, key, order, category)
        .join(origin, "prev")
        .join(target, category)
        .groupBy(key, "from_label", "to_label")
        .agg(
            F.count(F.lit(1)).alias("switches"),
            F.count_if(F.col("prev2") == F.col(category)).alias("undoing"),
        )
    )
    pair_order = Window.partitionBy(key).orderBy("from_label", "to_label")
    marked = pairs.select(
        "from_label",
        "to_label",
        "switches",
        "undoing",
        (F.row_number().over(pair_order) == 1).cast("long").alias("first"),
    )
    # One empty row keeps the total when nothing ever switched.
    nothing = fact.sparkSession.range(1).selectExpr(
        "CAST(NULL AS STRING) AS from_label",
        "CAST(NULL AS STRING) AS to_label",
        "0L AS switches",
        "0L AS undoing",
        "0L AS first",
    )
    from_label, to_label = F.col("from_label"), F.col("to_label")
    is_total = F.grouping_id() != 0
    return (
        marked.unionByName(nothing)
        .groupingSets([[from_label, to_label], []], from_label, to_label)
        .agg(
            is_total.alias("__total"),
            F.sum("switches").alias("switches"),
            F.when(is_total, F.sum("first")).otherwise(F.count(F.lit(1))).alias("institutions"),
            F.sum("undoing").alias("undoing_previous_switch"),
        )
        .where(F.col("__total") | from_label.isNotNull())
        .select(
            F.when(F.col("__total"), total).otherwise(from_label).alias("from_sector"),
            F.when(F.col("__total"), total).otherwise(to_label).alias("to_sector"),
            "switches",
            "institutions",
            "undoing_previous_switch",
            "__total",
        )
        .orderBy("__total", F.desc("switches"), "from_sector", "to_sector")
        .drop("__total")
    )
