"""Benchmark decontamination by spaced seeds.

Only DataFrame functions. A mask reads some positions of a short run of words and ignores the others, so a run with
substituted words still has the same hash wherever the mask ignores them. Hashes of test items meet hashes of all
training positions; around each hit the two texts are laid side by side and compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed masks over eight words: 1 is read, 0 is ignored. The last one ignores both ends; together they leave no allowed
# choice of substituted words in an item of 8 to 13 words without a seed.
MASKS = ("11100101", "11011001", "10010111", "01111010")
SPAN = 8
# An overlap is a run of this many words (the whole item if shorter) of which this share is equal.
OVERLAP_WORDS = 13
SIMILARITY = 0.8
# Seeds of the test items sent to every task; above this many they are joined by a shuffle instead.
MOST_BROADCAST_SEEDS = 500_000


def words(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits, in order."""
    bare = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    found = F.transform(F.split(bare, r"[^\p{L}\p{N}]+", -1), lambda w: F.xxhash64(w))
    return F.when(bare != "", found).otherwise(F.array().cast("array<long>"))


def seeds(rows: DataFrame, *carried: str) -> DataFrame:
    """``(*carried, at, seed)``: for every word position, the hash each mask reads from the run that starts there.

    ``rows`` has an array ``words``; runs that would pass its end are left out.
    """
    last = F.size("words") - SPAN
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    placed = rows.select(*dict.fromkeys([*carried, "words"]), F.explode(starts).alias("at"))
    hashes = [
        F.xxhash64(F.lit(number), *[F.get("words", F.col("at") + i) for i, read in enumerate(mask) if read == "1"])
        for number, mask in enumerate(MASKS)
    ]
    return placed.select(*carried, "at", F.explode(F.array(*hashes)).alias("seed"))


def whole_items(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Where all words of an item too short for a mask stand in a row: the first place of each text and item.

    The hash of the whole item meets the hashes of all runs of its length; only lengths that items have are hashed.
    """
    none = F.array().cast("array<struct<at:int,run:bigint,size:int>>")

    def of_length(size: int) -> Column:
        def run(at: Column) -> Column:
            return F.struct(
                at.alias("at"), F.xxhash64(F.slice("words", at + 1, size)).alias("run"), F.lit(size).alias("size")
            )

        last = F.size("words") - size
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), run)).otherwise(none)

    sizes = sorted(r["size"] for r in items.select(F.size("item_words").alias("size")).distinct().collect())
    runs = F.concat(none, *map(of_length, sizes))
    placed = rows.select("doc_id", "text_hash", "words", F.inline(runs))
    short = items.select("item_id", "item_words", F.xxhash64("item_words").alias("run"), F.size("item_words").alias("size"))
    same = placed.join(short, ["run", "size"]).where(F.slice("words", F.col("at") + 1, F.col("size")) == F.col("item_words"))
    first = same.groupBy("doc_id", "text_hash", "item_id").agg(F.max(F.struct("size", (-F.col("at")).alias("early"))).alias("found"))
    return first.select(
        "doc_id",
        "text_hash",
        "item_id",
        (-F.col("found.early")).alias("doc_word"),
        F.lit(0).alias("item_word"),
        F.col("found.size").alias("n_words"),
        F.col("found.size").alias("n_equal"),
    )


def overlaps(
    docs: DataFrame,
    tests: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    overlap_words: int = OVERLAP_WORDS,
    similarity: float = SIMILARITY,
    most_broadcast: int = MOST_BROADCAST_SEEDS,
) -> DataFrame:
    """``(doc_id, text_hash, item_id, doc_word, item_word, n_words, n_equal)``, one row per document text and item.

    The two word sequences are aligned at each hit without gaps. They overlap if some run of ``overlap_words`` words
    is equal in at least ``similarity`` of its positions; ``n_words`` words from ``doc_word`` and ``item_word`` (from
    0) are side by side in the alignment with most equal words. Items of fewer words than a mask (eight) match where
    all their words stand in a row. Items without a word match nothing, as do null and empty texts. Repeated rows give
    one row; documents and items without an id are compared and carry null. Empty tables give no rows; other columns
    are not read.
    """
    every = tests.select(F.col(item_col).alias("item_id"), words(F.col(item_text_col)).alias("item_words")).distinct()
    short = every.where(F.size("item_words").between(1, SPAN - 1))
    # An item is its id and its words: ids may be null or stand on several texts.
    items = every.where(F.size("item_words") >= SPAN).withColumn("item", F.xxhash64("item_id", "item_words"))
    item_seeds = seeds(items.withColumn("words", F.col("item_words")), "item", "item_words")
    item_seeds = item_seeds.select(
        "item", F.size("item_words").alias("item_size"), F.col("at").alias("item_at"), "seed"
    ).distinct()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), words(text).alias("words")
    )
    diagonal = (F.col("at") - F.col("item_at")).alias("diagonal")
    shown = F.slice(
        F.col("words"),
        F.greatest(F.col("diagonal"), F.lit(0)) + 1,
        F.col("item_size") + F.least(F.col("diagonal"), F.lit(0)),
    )
    if item_seeds.limit(most_broadcast + 1).count() <= most_broadcast:
        hits = seeds(rows, "doc_id", "text_hash", "words").join(F.broadcast(item_seeds), "seed")
        aligned = hits.select("doc_id", "text_hash", "words", "item", "item_size", diagonal)
        sides = aligned.select("doc_id", "text_hash", "item", "diagonal", shown.alias("shown")).distinct()
    else:
        hits = seeds(rows, "doc_id", "text_hash").join(item_seeds, "seed")
        hits = hits.select("doc_id", "text_hash", "item", "item_size", diagonal).distinct()
        same = (F.col("text_hash") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("d"))
        texts = rows.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "words")
        sides = hits.join(texts, same).select("doc_id", "text_hash", "item", "diagonal", shown.alias("shown"))
        sides = sides.distinct()
    item_from = F.greatest(-F.col("diagonal"), F.lit(0))
    equal = F.zip_with(
        "shown",
        F.slice("item_words", item_from + 1, F.size("shown")),
        lambda a, b: (a == b).cast("int"),
    )
    compared = sides.join(items, "item").select(
        "doc_id",
        "text_hash",
        "item_id",
        "diagonal",
        item_from.alias("item_word"),
        F.size("item_words").alias("item_size"),
        equal.alias("equal"),
    )
    run = F.least(F.lit(overlap_words), F.col("item_size"))
    overlapping = F.exists(
        F.sequence(F.lit(1), F.size("equal") - run + 1),
        lambda i: F.aggregate(F.slice(F.col("equal"), i, run), F.lit(0), lambda a, b: a + b) >= run * similarity,
    )
    verified = compared.where(F.when(F.size("equal") >= run, overlapping).otherwise(F.lit(False)))
    best = verified.select(
        "doc_id",
        "text_hash",
        "item_id",
        F.struct(
            F.aggregate("equal", F.lit(0), lambda a, b: a + b).alias("n_equal"),
            F.size("equal").alias("n_words"),
            (-F.greatest(F.col("diagonal"), F.lit(0))).alias("from_end"),
            "item_word",
        ).alias("found"),
    )
    aligned = best.groupBy("doc_id", "text_hash", "item_id").agg(F.max("found").alias("found")).select(
        "doc_id",
        "text_hash",
        "item_id",
        (-F.col("found.from_end")).alias("doc_word"),
        "found.item_word",
        "found.n_words",
        "found.n_equal",
    )
    if short.isEmpty():
        return aligned
    both = aligned.unionByName(whole_items(rows, short))
    most = F.max(F.struct("n_equal", "n_words", (-F.col("doc_word")).alias("early"), "item_word")).alias("found")
    chosen = both.groupBy("doc_id", "text_hash", "item_id").agg(most)
    return chosen.select(
        "doc_id",
        "text_hash",
        "item_id",
        (-F.col("found.early")).alias("doc_word"),
        *[f"found.{name}" for name in ("item_word", "n_words", "n_equal")],
    )


def decontaminate(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` whose text overlaps no test item; all other rows and columns stay as they are."""
    found = overlaps(docs, tests, id_col, text_col, **settings)
    leaked = found.select(F.col("doc_id").alias("leaked_id"), F.col("text_hash").alias("leaked_hash")).distinct()
    text = F.coalesce(docs[text_col], F.lit(""))
    same = (F.xxhash64(text) == leaked["leaked_hash"]) & docs[id_col].cast("long").eqNullSafe(leaked["leaked_id"])
    return docs.join(leaked, same, "left_anti")
