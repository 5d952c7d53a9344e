"""Importance resampling towards a target corpus: hashed word features, Gumbel noise, a distributed quickselect.

A word's bucket gains by how much likelier it is in the target than in the source, in integer thousandths, so sums do
not depend on their order. A document weighs the gains of its words. Adding Gumbel noise, drawn from a hash of the id,
and keeping the highest scores draws without replacement in proportion to the exponent of the weight.

The draw needs the k-th key only. Rounds of quickselect take some rows still in question as pivots, count the rows
below, at and above each one exactly, and keep the one gap that holds the k-th; only the winners are then sorted.

Nulls and empties: a null or empty text has no words and weight 0; a null id is written as an empty text in the hash.
Ties go to the smaller id (null first), then to the text's hash; rows equal in all three are alike, and where only some
of them fit, the rest stays undrawn. Columns beside id and text are left alone and may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, stored

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
PIVOTS = 16
# Runs of what is no separator below U+0080: digits, small letters and all that is not ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """All words of a text, repeats included; a null text has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def bucket(word: Column, buckets: int = BUCKETS) -> Column:
    return (F.crc32(word.cast("binary")) % buckets).cast("int")


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)``: the words of all texts by bucket; combined before the shuffle, so frequent words are no burden."""
    found = docs.select(F.explode(words(F.col(text_col))).alias("word"))
    return found.groupBy(bucket(F.col("word"), buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The gain of each bucket in thousandths, from two tables of bucket counts (``buckets`` rows at most)."""

    def counted(counts: DataFrame) -> list[int]:
        found = dict(counts.collect())
        return [found.get(number, 0) for number in range(buckets)]

    s, t = counted(source), counted(target)
    all_s, all_t = sum(s) + buckets, sum(t) + buckets
    return [math.floor(1000 * math.log((t[i] + 1) * all_s / ((s[i] + 1) * all_t))) for i in range(buckets)]


def noise(row_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from the id's hash."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def scores(docs: DataFrame, weights: list[int], id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """``(id, n_features, weight, score, text_hash)`` per row."""
    spark = docs.sparkSession
    # One row of fixed size beside every document.
    table = spark.createDataFrame([(weights,)], "__gains array<int>")
    found = F.transform(words(F.col(text_col)), lambda word: bucket(word, len(weights)))
    total = F.aggregate(
        "__buckets", F.lit(0).cast("long"), lambda so_far, b: so_far + F.element_at("__gains", b + 1).cast("long")
    )
    return (
        docs.select(F.col(id_col).alias("__id"), found.alias("__buckets"), F.xxhash64(F.col(text_col)).alias("text_hash"))
        .crossJoin(F.broadcast(table))
        .select(
            F.col("__id").alias(id_col),
            F.size("__buckets").cast("long").alias("n_features"),
            total.alias("weight"),
            (total + noise(F.col("__id"), seed)).cast("long").alias("score"),
            "text_hash",
        )
    )


def first_keys(rows: DataFrame, k: int, order: list[str], pivots: int = PIVOTS) -> DataFrame:
    """The ``k`` rows of least key ``order`` (nulls first), unsorted. No two rows may share a key.

    Each round draws ``pivots`` keys by a hash among the rows still in question and counts the rows below, at and above
    each, exactly: two scans, and one line to the driver. What is in question shrinks about ``pivots``-fold a round,
    whatever the values are. ``rows`` should be a stored table.
    """
    kinds = [rows.schema[name].dataType for name in order]
    key, lead = F.struct(*order), F.col(order[0])

    def literal(bound: tuple) -> Column:
        return F.struct(*[F.lit(value).cast(kind) for value, kind in zip(bound, kinds)])

    size = rows.count()
    if k <= 0 or k >= size:
        return rows if k > 0 else rows.limit(0)
    rest, turn = rows.select(*order), 0
    while True:
        drawn = rest.orderBy(F.xxhash64(F.lit(turn), *order), *order).limit(pivots).collect()
        bounds = sorted((tuple(row) for row in drawn), key=lambda row: [(value is not None, value) for value in row])
        counts = rest.agg(
            *[F.count_if(key < literal(bound)).alias(f"under{i}") for i, bound in enumerate(bounds)],
            *[F.count_if(key == literal(bound)).alias(f"at{i}") for i, bound in enumerate(bounds)],
        ).first()
        low, high, passed = None, None, 0
        for i, bound in enumerate(bounds):
            under, upto = counts[f"under{i}"], counts[f"under{i}"] + counts[f"at{i}"]
            if under < k <= upto:
                return rows.where(key <= literal(bound))
            if k <= under:
                high = bound
                break
            low, passed = bound, upto
        # The first column is compared by itself too, which the scan can use to skip row groups.
        if low is not None:
            rest = rest.where((key > literal(low)) & _at_least(lead, low[0]))
        if high is not None:
            rest = rest.where((key < literal(high)) & _at_most(lead, high[0]))
        k, turn = k - passed, turn + 1


def _at_least(column: Column, value) -> Column:
    return F.lit(True) if value is None else column >= F.lit(value)


def _at_most(column: Column, value) -> Column:
    return column.isNull() if value is None else column.isNull() | (column <= F.lit(value))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """``(id, n_features, weight, score, rank)`` per row: ``rank`` from 1 for the drawn ``percent`` of the rows that have
    at least ``least_words`` words, null for all others. Without rows there is no result; without target texts every
    bucket's target count is 0."""
    weights = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text_col, buckets), buckets)
    scored = scores(docs, weights, id_col, text_col, seed).withColumn("__row", F.monotonically_increasing_id())
    scored = stored(scored.withColumn("__fall", -F.col("score")), "scores")
    able = scored.where(F.col("n_features") >= least_words)
    order = ["__fall", id_col, "text_hash", "__row"]
    winners = stored(first_keys(able, able.count() * percent // 100, order).select(*order), "winners")
    ranked = numbered(winners, order).select("__row", (F.col("__place") + 1).alias("rank"))
    return scored.join(ranked, "__row", "left").select(id_col, "n_features", "weight", "score", "rank")
