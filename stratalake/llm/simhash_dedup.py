"""SimHash near-duplicates: pivot distance tables discard candidate pairs, survivors are verified bit by bit.

Fingerprints are taken per document in Arrow batches; everything after works on distinct fingerprints, so a group of
copies counts once. Links at up to ``radius`` differing bits become components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, map_batches, stored, utf8, whole_groups

SHINGLE_WORDS = 3
RADIUS = 3
HASH_SEED = 42
# Fingerprints sharing one candidate key that one task compares; larger groups are cut into pieces of this size.
PIECE = 4096
# Reference fingerprints of the distance table.
PIVOTS = np.array(
    [xxhash.xxh64_intdigest(i.to_bytes(4, "little"), HASH_SEED) for i in range(16)], dtype=np.uint64
)
BITS = 64


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """Bit i is set if bit i of over half the shingles' XXH64 is set. A-Z count as a-z; no words: zero."""
    words = text.lower().split()  # of bytes: ASCII letters only, split at space and \t \n \v \f \r
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [digest(b" ".join(words), HASH_SEED)]
    else:
        shifted = [words[i:] for i in range(shingle)]
        hashes = [digest(s, HASH_SEED) for s in map(b" ".join, zip(*shifted, strict=False))]
    votes = np.zeros(BITS, dtype=np.int64)
    packed = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, len(packed), 1 << 14):  # a very long text is counted in blocks
        votes += np.unpackbits(packed[at : at + (1 << 14)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS, hashed: bool = False
) -> DataFrame:
    """``(doc_id, fp)`` of every row, and ``text_hash`` if ``hashed``; ``fp`` holds the 64 bits as a signed long. Null
    text counts as empty."""
    extra = [text_hash(text_col).alias("text_hash")] if hashed else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in utf8(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]], ["doc_id", "fp", *batch.schema.names[2:]]
            )

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *extra)
    return map_batches(narrow, run, "doc_id long, fp long" + (", text_hash long" if hashed else ""))


def candidate_keys(fp: Column, radius: int) -> Column:
    """Keys of which two fingerprints at up to ``radius`` differing bits share at least one.

    The bits are cut into twice ``radius`` blocks (at least two); ``radius`` differing bits leave at least half of
    them untouched, so one choice of that many blocks agrees. Each key is the number of the choice and its bits.
    """
    blocks = max(2 * radius, 2)
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = 0
        for block in chosen:
            mask |= ((1 << edges[block + 1]) - 1) ^ ((1 << edges[block]) - 1)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(number), fp.bitwiseAND(F.lit(signed).cast("long"))))
    return F.array(*keys)


def link_groups(keys: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join, within each run of equal ``keys``, the fingerprints connected at up to ``radius`` bits.

    The distance table holds each fingerprint's distance to every pivot. By the triangle inequality a pair whose
    largest coordinate difference exceeds ``radius`` is no link; only survivors have their bits counted. A pair that
    earlier links already connect is skipped, so a group of n yields fewer than n links.
    """
    grouped = np.zeros(len(keys), dtype=bool)
    same = keys[1:] == keys[:-1]
    grouped[1:] |= same
    grouped[:-1] |= same
    keys, fps = keys[grouped], fps[grouped]
    table = np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    parent = np.arange(len(fps))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    left, right = [], []
    at, shift = np.arange(max(len(fps) - 1, 0)), 1
    while len(at):
        at = at[at + shift < len(fps)]
        at = at[keys[at] == keys[at + shift]]
        open_pairs = at[parent[at] != parent[at + shift]]
        near = np.abs(table[open_pairs] - table[open_pairs + shift]).max(axis=1, initial=0) <= radius
        survivors = open_pairs[near]
        linked = survivors[np.bitwise_count(fps[survivors] ^ fps[survivors + shift]) <= radius]
        for i in linked.tolist():
            a, b = root(i), root(i + shift)
            if a != b:
                parent[max(a, b)] = min(a, b)
                left.append(i)
                right.append(i + shift)
        if len(linked):
            while not np.array_equal(parent, flat := parent[parent]):
                parent[:] = flat
        shift += 1
    return fps[left], fps[right]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp`` that connect all pairs at up to ``radius`` bits.

    Rows meet by candidate key. A key shared by more than ``PIECE`` fingerprints is cut into pieces, and every two
    pieces meet in a group of their own, so no task holds an unbounded group.
    """
    keyed = distinct.select("fp", F.explode(candidate_keys(F.col("fp"), radius)).alias("key"))
    crowded = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > PIECE)
    crowded = crowded.select("key", F.ceil(F.col("n") / PIECE).cast("int").alias("pieces"))
    own = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    met = F.when(F.col("pieces").isNull(), F.array(F.lit(0))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("pieces") - 1),
            lambda other: F.least(own, other) * F.col("pieces") + F.greatest(own, other),
        )
    )
    groups = keyed.join(crowded, "key", "left").select("fp", "key", F.explode(met).alias("pair"))
    groups = groups.select("fp", F.xxhash64("key", "pair").alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "key", 1 << 16):
            a, b = link_groups(
                table.column("key").to_numpy(), table.column("fp").to_numpy().view(np.uint64), radius
            )
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    ordered = groups.repartition("key").sortWithinPartitions("key")
    return map_batches(ordered, run, "a long, b long")


def rooted(prints: DataFrame, first: Column, radius: int) -> DataFrame:
    """``(fp, first, root)`` of the distinct fingerprints in ``prints``: the aggregate ``first`` of each one's rows and
    the least fingerprint of its component."""
    firsts = prints.groupBy("fp").agg(first.alias("first"))
    roots = stored(components(links(prints.select("fp").distinct(), radius)), "roots")
    return firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    radius: int = RADIUS,
) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row: the least id reachable over links of up to ``radius`` bits.

    Null or empty text has fingerprint zero and links like any other. Rows without an id are returned with the least
    id they reach, or null; repeated rows are repeated. An empty table gives no rows. Other columns are not read.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    known = rooted(prints, F.min("doc_id"), radius)
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = known.join(least, "root").select("fp", "component_id")
    return prints.join(labels, "fp").select("doc_id", "fp", "component_id")


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    radius: int = RADIUS,
) -> DataFrame:
    """One row of ``docs`` for each component: the one of least id, among several texts of that id of least text hash.

    An id on unlike texts stands in several components and is kept once for each that it is the least of. Rows
    without an id come after all others of their component, so a component of such rows alone keeps one text. Of rows
    equal in id and text, the one whose columns (maps aside) hash least stays. An empty table gives no rows.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle, hashed=True), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    least = rooted(prints, F.min(row), radius).groupBy("root").agg(F.min("first").alias("least"))
    kept = least.select(F.col("least.doc_id").alias("kept_id"), F.col("least.text_hash").alias("kept_hash"))
    # Copies become one row before the shuffle, however many there are.
    hashed = [F.col(f"`{c.name}`") for c in docs.schema if "map<" not in c.dataType.simpleString()]
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    once = docs.groupBy(F.col(id_col).cast("long").alias("__id"), text_hash(text_col).alias("__hash")).agg(
        F.min_by(whole, F.xxhash64(*hashed)).alias("__row")
    )
    same = once["__id"].eqNullSafe(kept["kept_id"]) & (once["__hash"] == kept["kept_hash"])
    return once.join(kept, same, "left_semi").select("__row.*")
