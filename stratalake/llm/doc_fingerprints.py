"""SimHash document fingerprints: weighted term hashes vote on signed bits, permuted block tables search by distance.

Only DataFrame functions. A term is a run of ``term_words`` words, weighted by its length in characters; repeats add
up. The 64 votes of a document are plain sums of one hash aggregate.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BITS = 64
TERM_WORDS = 2
# Ids ordered by one task, and the most ranges; beyond that ranges grow, at eight bytes an id.
IDS_PER_RANGE = 20_000
MOST_RANGES = 1000
SEARCH_RADIUS = 3
SEARCHED = 100


def votes(rows: DataFrame, keys: list[str], text_col: str, term_words: int = TERM_WORDS) -> DataFrame:
    """``(*keys, copies, fp)`` for every distinct combination of ``keys``, whose rows must hold equal texts.

    ``fp`` is a signed long, ``copies`` the number of rows. Each bit has a counter of 64 bits, as the weights of all
    copies add up. Words are what white space separates, lower-cased; fewer
    words than a term make one term, none give zero.
    """
    words = F.split(F.lower(F.trim(F.coalesce(F.col(text_col), F.lit("")), F.lit(" \t\n\r\f\v"))), r"\s+", -1)
    split = rows.select(*keys, words.alias("words"))
    last = F.greatest(F.size("words") - F.lit(term_words - 1), F.lit(1))
    terms = split.select(*keys, "words", F.explode(F.sequence(F.lit(1), last)).alias("at"))
    parts = [F.coalesce(F.get("words", F.col("at") + i - 1), F.lit("")) for i in range(term_words)]
    weight = sum((F.length(p) for p in parts[1:]), F.length(parts[0])).cast("long")
    hashed = terms.select(*keys, (F.col("at") == 1).cast("long").alias("row"), F.xxhash64(*parts).alias("h"), weight.alias("w"))
    counts = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(F.lit(1)) * F.col("w")).alias(f"v{i}") for i in range(BITS)]
    counted = hashed.groupBy(*keys).agg(F.sum("row").alias("copies"), F.sum("w").alias("weights"), *counts)
    bits = []
    for i in range(BITS):
        signed = F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")
        bits.append(F.when(F.col(f"v{i}") * 2 > F.col("weights"), signed).otherwise(F.lit(0).cast("long")))
    return counted.select(*keys, "copies", F.aggregate(F.array(*bits), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b)).alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, from 0 to 1."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def block_tables(radius: int) -> list[tuple[int, list[int]]]:
    """``(mask, earlier masks)`` of the permuted tables: bits cut into ``radius + 2`` blocks, two of which agree in
    one table each. Among up to ``radius`` differing bits at least two blocks stay untouched."""
    blocks = radius + 2
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), 2):
        mask = 0
        for block in chosen:
            mask |= (1 << edges[block + 1]) - (1 << edges[block])
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return [(mask, masks[:i]) for i, mask in enumerate(masks)]


def within(queries: DataFrame, table: DataFrame, radius: int) -> DataFrame:
    """``(fp, near, distance)``: every fingerprint ``near`` of ``table`` within ``radius`` bits of one in ``queries``.

    Both sides hold distinct longs in column ``fp``. Each of the permuted tables joins on the bits of two blocks; the
    distance and "not already met in an earlier table" are conditions of the join itself, so it emits results only.
    """
    tables = block_tables(radius)
    keys = F.array(*[F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, (m, _) in enumerate(tables)])
    left = queries.select("fp", F.inline(keys))
    right = table.select(F.col("fp").alias("near"), F.inline(keys)).withColumnsRenamed({"table": "t", "bits": "b"})
    differing = F.col("fp").bitwiseXOR(F.col("near"))
    first = F.lit(True)
    for i, (mask, _) in enumerate(tables[:-1]):
        first = first & ((F.col("table") <= i) | (differing.bitwiseAND(F.lit(mask)) != 0))
    met = (F.col("table") == F.col("t")) & (F.col("bits") == F.col("b")) & (F.bit_count(differing) <= radius) & first
    return left.join(right, met).select("fp", "near", F.bit_count(differing).alias("distance"))


def following(ids: DataFrame) -> DataFrame:
    """``(id, next)`` over the distinct non-null ``id`` in ascending order; the first follows the last.

    Ids are dealt into ranges; each range is ordered by itself, and only the ranges' least ids are ordered together.
    """
    distinct = ids.where("id IS NOT NULL").distinct()
    parts = min(MOST_RANGES, max(1, distinct.count() // IDS_PER_RANGE))
    ranged = stored(distinct.repartitionByRange(parts, "id").select("id", F.spark_partition_id().alias("part")), "id-ranges")
    inside = Window.partitionBy("part").orderBy("id")
    ordered = ranged.select("id", "part", F.lead("id").over(inside).alias("next"))
    firsts = ranged.groupBy("part").agg(F.min("id").alias("first"))
    across = Window.orderBy("part")  # one row per range
    everything = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = firsts.select("part", F.lead("first").over(across).alias("after"), F.min("first").over(everything).alias("least"))
    return ordered.join(heads, "part").select("id", F.coalesce("next", "after", "least").alias("next"))


def edited_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, next_id, text, edited)`` per row: the last quarter of the code points (rounded down) is replaced by
    as much of the beginning of the next document's text, all of it if shorter.

    The next document is the one with the next id, after the last the first. Null text is empty. Each row that repeats
    an id counts; as a next document such an id gives its least beginning. Rows without an id are their own next.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Rows without an id get a key of their own, so that they do not all meet in one place.
    nameless = F.concat(F.lit("?"), F.hex(F.xxhash64(text)))
    base = docs.select(F.coalesce(F.col(id_col).cast("long").cast("string"), nameless).alias("key"), text.alias("text"))
    number = F.when(~F.col("key").startswith("?"), F.col("key").cast("long"))
    share = F.floor(F.length("text") / 4).cast("int")
    sizes = base.select(number.alias("id"), share.alias("share")).where("id IS NOT NULL")
    sizes = sizes.groupBy("id").agg(F.max("share").alias("share"))
    needed = following(base.select(number.alias("id"))).join(sizes, "id").select(
        F.col("next").cast("string").alias("key"), F.col("id").alias("wanted_by"), "share"
    )
    # Whole texts are dealt by key once, for both joins; only what replaces a quarter travels to the document before.
    heads = base.join(needed, "key").select(
        F.col("wanted_by").cast("string").alias("key"),
        number.alias("next_id"),
        F.substring("text", F.lit(1), F.col("share")).alias("head"),
    )
    heads = heads.groupBy("key").agg(F.min("next_id").alias("next_id"), F.min("head").alias("head"))
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - share),
        F.substring(F.coalesce("head", "text"), F.lit(1), share),
    )
    return base.join(heads, "key", "left").select(number.alias("doc_id"), "next_id", "text", edited.alias("edited"))


def edited_fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    term_words: int = TERM_WORDS,
    radius: int = SEARCH_RADIUS,
    searched: int = SEARCHED,
) -> DataFrame:
    """Per row ``(doc_id, n_chars, edited_sha256, fp, edited_fp, near_edited, near_next, n_within)``.

    ``n_within`` counts the rows whose fingerprint lies within ``radius`` bits, itself included; it is searched for
    rows whose id is divisible by ``searched`` and null for others. See ``edited_texts`` for nulls and repeated rows;
    a repeated id gives its least fingerprint as a next document. An empty table gives no rows; other columns are not
    read.
    """
    rows = edited_texts(docs, id_col, text_col).select(
        "doc_id",
        "next_id",
        F.length("text").cast("long").alias("n_chars"),
        F.unhex(F.sha2("edited", 256)).alias("edited_sha256"),
        F.xxhash64("text").alias("text_hash"),
        F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("text")))).alias("of"),
    )
    names = ["doc_id", "next_id", "n_chars", "edited_sha256", "text_hash"]
    sides = votes(rows.select(*names, "of.side", "of.text"), [*names, "side"], "text", term_words)
    prints = stored(
        sides.groupBy(*names).agg(
            F.max("copies").alias("copies"),
            F.max(F.when(F.col("side") == 0, F.col("fp"))).alias("fp"),
            F.max(F.when(F.col("side") == 1, F.col("fp"))).alias("edited_fp"),
        ),
        "document-fingerprints",
    )
    of_next = prints.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("next_id")).agg(F.min("fp").alias("next_fp"))
    distinct = prints.groupBy("fp").agg(F.sum("copies").alias("rows"))
    queries = prints.where(F.col("doc_id") % searched == 0).select("fp").distinct()
    found = within(queries, distinct.select("fp"), radius)
    counted = (
        found.join(distinct.withColumnRenamed("fp", "near"), "near").groupBy("fp").agg(F.sum("rows").alias("n_within"))
    )
    # Only rows that ask meet the counts: a join of all rows would deal every other row to the null key.
    asks = F.coalesce(F.col("doc_id") % searched == 0, F.lit(False))
    others = prints.where(~asks).withColumn("n_within", F.lit(None).cast("long"))
    answered = prints.where(asks).join(counted, "fp").unionByName(others)
    return (
        answered.join(of_next, "next_id", "left")
        .select(
            "doc_id",
            "n_chars",
            F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
            "fp",
            "edited_fp",
            likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
            likeness(F.col("fp"), F.coalesce("next_fp", "fp")).alias("near_next"),
            "n_within",
            F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
        )
        .drop("copy")
    )
