"""Removal of every byte that lies in a string of ``window`` bytes found more than once, by sharded suffix arrays.

Equal windows must meet in one shard. Each window is filed under its anchor, the run of ``ANCHOR`` bytes inside it
with the least hash: equal windows have equal anchors. Consecutive windows with the same anchor form a segment, and
only segments whose anchor occurs more than once anywhere are fetched, each distinct text once with its number of
occurrences. Shards of segments are sorted by induced sorting; permuted common prefixes of at least a window show
which windows repeat. Anchors with very many different segments are filed again under ever longer contexts, at last
the whole window, so no shard is unbounded. Texts are read from the input where they are needed and travel compressed;
no copy of them is stored. Keys that hold more than their share of all segments are joined by broadcast of those few
keys, never in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import consumed, map_batches, shuffles_removed, stored, stored_at, utf8, whole_groups
from .suffix_array import permuted_common_prefixes, suffix_array

WINDOW = 400
ANCHOR = 64
BASE = np.uint64(0x9E3779B97F4A7C15)
# Longest piece of a text in which anchors are sought, bytes of shorter pieces taken together for that (their arrays
# should fit a processor's cache), and bytes sorted at once in a shard.
BLOCK = 1 << 20
GATHERED = 1 << 16
SHARD = 1 << 19
# Different segments under one anchor that a shard takes; beyond, windows are filed by offset in steps of these.
MOST_SEGMENTS = 4096
WIDTHS = (32, 1)
# What identifies a segment's text: where it is filed, its own hash, its windows and its anchor's offset.
SEGMENT = ["key", "text_key", "windows", "offset"]
# A key on more than one in this many of all segments is hot; there are fewer hot keys than this.
HOT_SHARE = 1000


def anchors(data: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window start the position of its anchor, and the hash of the run at every position."""
    runs = data.astype(np.uint64) + np.uint64(1)
    power = np.full(1, BASE)
    step = 1
    while step < ANCHOR:
        runs = runs[:-step] * power + runs[step:]
        power = power * power
        step *= 2
    runs ^= runs >> np.uint64(29)
    runs *= np.uint64(0xBF58476D1CE4E5B9)
    runs ^= runs >> np.uint64(32)
    least = runs
    at = np.arange(len(runs), dtype=np.int32)
    width = window - ANCHOR + 1
    covered = 1
    while covered < width:
        step = min(covered, width - covered)
        left = least[:-step] <= least[step:]  # the leftmost of equals, so that equal windows agree
        at = np.where(left, at[:-step], at[step:])
        least = np.where(left, least[:-step], least[step:])
        covered += step
    return at, runs


def segments(texts: list[bytes], window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``(text, start, windows, offset, key, text_key)`` arrays; ``offset`` is from the first window to the anchor."""

    def found(pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
        data = b"".join(p[2] for p in pieces)
        at, runs = anchors(np.frombuffer(data, np.uint8), window)
        sizes = np.array([len(p[2]) for p in pieces])
        firsts = np.cumsum(sizes) - sizes
        piece = np.repeat(np.arange(len(pieces)), np.maximum(sizes - window + 1, 0))
        starts = np.arange(len(piece)) - np.repeat(
            np.cumsum(np.maximum(sizes - window + 1, 0)) - np.maximum(sizes - window + 1, 0), np.maximum(sizes - window + 1, 0)
        )
        places = firsts[piece] + starts
        anchor = at[places].astype(np.int64)
        new = np.ones(len(places), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
        begin = np.flatnonzero(new)
        counts = np.diff(np.append(begin, len(places)))
        where = places[begin]
        digest = xxhash.xxh3_64_intdigest
        spans = zip(where.tolist(), (where + counts + window - 1).tolist(), strict=True)
        keys = np.array([digest(data[a:b]) for a, b in spans], dtype=np.uint64)
        owner = np.array([p[0] for p in pieces])[piece[begin]]
        shift = np.array([p[1] for p in pieces])[piece[begin]]
        return owner, starts[begin] + shift, counts, anchor[begin] - where, runs[anchor[begin]].view(np.int64), keys.view(np.int64)

    pieces: list[tuple[int, int, bytes]] = []
    held = 0
    for number, text in enumerate(texts):
        if len(text) < window:
            continue
        for at in range(0, len(text) - window + 1, BLOCK):
            pieces.append((number, at, text[at : at + BLOCK + window - 1]))
            held += len(pieces[-1][2])
            if held >= min(GATHERED, BLOCK):
                yield found(pieces)
                pieces, held = [], 0
    if pieces:
        yield found(pieces)


def filed(rows: DataFrame, window: int) -> DataFrame:
    """``(row_id, row_hash, segments)`` per row: its segments, each a ``start`` and the columns of ``SEGMENT``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = list(utf8(batch.column(2)))
            found = list(segments(texts, window))
            owner = np.concatenate([np.zeros(0, np.int64), *(part[0] for part in found)])
            kinds = {"start": np.int64, "windows": np.int32, "offset": np.int32, "key": np.int64, "text_key": np.int64}
            fields = {
                name: np.concatenate([np.zeros(0, kind), *(part[i].astype(kind) for part in found)])
                for i, (name, kind) in enumerate(kinds.items(), start=1)
            }
            ends = owner.searchsorted(np.arange(len(texts) + 1)).astype(np.int32)
            names = ["start", *SEGMENT]
            lists = pa.ListArray.from_arrays(
                pa.array(ends), pa.StructArray.from_arrays([pa.array(fields[n]) for n in names], names)
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["row_id", "row_hash", "segments"])

    one = "start: long, key: long, text_key: long, windows: int, offset: int"
    return map_batches(rows, run, f"row_id long, row_hash long, segments array<struct<{one}>>")


def compressed(rows: DataFrame) -> DataFrame:
    """``(doc_id, row_id, row_hash, packed)``: the rows with their text compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed = pa.array([packer.compress(text) for text in utf8(batch.column(3))], pa.binary())
            names = ["doc_id", "row_id", "row_hash"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), packed], [*names, "packed"])

    return map_batches(
        rows.select("doc_id", "row_id", "row_hash", "text"), run, "doc_id long, row_id long, row_hash long, packed binary"
    )


def repeated(found: DataFrame) -> DataFrame:
    """The segments whose key occurs more than once. Hot keys are few, so they are sent to the segments; all others
    are joined by a shuffle in which no key has more than its share."""
    counts = stored(found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "repeated-keys")
    least = (counts.agg(F.sum("n")).first()[0] or 0) / HOT_SHARE
    hot = F.broadcast(counts.where(F.col("n") > least).select("key"))
    others = counts.where(F.col("n") <= least).select("key")
    return found.join(hot, "key", "left_semi").unionByName(found.join(hot, "key", "left_anti").join(others, "key", "left_semi"))


def fetched(rows: DataFrame, wanted: DataFrame, function, schema: str) -> DataFrame:
    """``function`` over ``(text, its wanted segments)`` for the rows of text that have any.

    A text's segments travel to it as one list, at most as long as the text.
    """
    lists = wanted.groupBy("row_id", "row_hash").agg(F.collect_list(F.struct("start", *SEGMENT, "weight")).alias("wanted"))
    texts = rows.join(lists, ["row_id", "row_hash"]).select("row_id", "row_hash", "packed", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            wanted = batch.column(3)
            offsets = np.asarray(wanted.offsets)
            fields = {name: np.asarray(wanted.values.field(name)) for name in ["start", *SEGMENT, "weight"]}
            for number, packed in enumerate(batch.column(2)):
                text = unpacker.decompress(packed.as_py())
                part = {name: values[offsets[number] : offsets[number + 1]] for name, values in fields.items()}
                yield from function(batch.column(0)[number].as_py(), batch.column(1)[number].as_py(), text, part)

    return map_batches(texts, run, schema)


def distinct_segments(found: DataFrame) -> DataFrame:
    """One row per different segment with its ``weight``, the number of occurrences, and the place of one of them."""
    return found.groupBy(*SEGMENT).agg(
        F.count("*").alias("weight"), F.first("row_id").alias("row_id"), F.first("row_hash").alias("row_hash"), F.first("start").alias("start")
    )


def refiled(rows: DataFrame, crowded: DataFrame, width: int, window: int) -> DataFrame:
    """The windows of ``crowded`` segments filed anew: by steps of ``width`` of the anchor's offset and the bytes all
    windows of that step share."""

    def split(row_id: int, row_hash: int, text: bytes, part: dict) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        digest = xxhash.xxh3_64_intdigest
        for start, windows, offset, key in zip(*(part[n].tolist() for n in ("start", "windows", "offset", "key")), strict=True):
            anchor = start + offset
            at = start
            while at < start + windows:
                step = (anchor - at) // width
                upto = min(start + windows, anchor - step * width + 1)
                common = text[anchor - step * width : anchor - step * width - width + 1 + window]
                filed_at = digest(b"%d %d " % (step, key) + common)
                out.append((at, filed_at, digest(text[at : upto - 1 + window]), upto - at, anchor - at))
                at = upto
        table = [np.array(c) for c in zip(*out, strict=True)]
        start, key, text_key, windows, offset = table
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(out), row_id)),
                pa.array(np.full(len(out), row_hash)),
                pa.array(start.astype(np.int64)),
                pa.array(key.astype(np.uint64).view(np.int64)),
                pa.array(text_key.astype(np.uint64).view(np.int64)),
                pa.array(windows.astype(np.int32)),
                pa.array(offset.astype(np.int32)),
            ],
            ["row_id", "row_hash", "start", *SEGMENT],
        )

    return fetched(
        rows,
        crowded.withColumn("weight", F.lit(1).cast("long")),
        split,
        "row_id long, row_hash long, start long, key long, text_key long, windows int, offset int",
    )


def repeated_windows(pieces: list[bytes], windows: np.ndarray, weights: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """``(piece, first, last)`` runs of window starts whose window occurs more than once among the pieces' windows.

    The pieces lie side by side with a symbol between that no byte has. Suffixes whose common prefix is at least a
    window long stand together in order; a group's occurrences are the weights of the window starts in it.
    """
    sizes = np.array([len(p) for p in pieces])
    firsts = np.cumsum(sizes + 1) - sizes - 1
    # Symbols of 16 bits are dealt to buckets by a radix sort, wider ones by comparisons.
    text = np.ones(int(sizes.sum()) + len(pieces) + 1, dtype=np.uint16)
    for first, piece in zip(firsts.tolist(), pieces, strict=True):
        text[first : first + len(piece)] = np.frombuffer(piece, np.uint8)
        text[first : first + len(piece)] += 2
    text[-1] = 0
    owner = np.repeat(np.arange(len(pieces)), sizes + 1)
    owner = np.append(owner, -1)
    inside = np.arange(len(text)) - np.append(np.repeat(firsts, sizes + 1), 0)
    begins = (owner >= 0) & (inside < windows[owner])
    sa = suffix_array(text, 258)
    shared = permuted_common_prefixes(text, sa)[sa]
    group = np.cumsum(shared < window)
    weight = np.where(begins, weights[owner], 0)[sa]
    total = np.bincount(group, weights=weight)
    marked = np.zeros(len(text), dtype=bool)
    marked[sa] = (total[group] > 1) & begins[sa]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marked, [False]]).astype(np.int8)))
    runs = []
    for first, after in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        # Starts of neighbouring pieces never touch: a piece ends with window - 1 bytes that begin no window of it.
        runs.append((int(owner[first]), int(inside[first]), int(inside[after - 1])))
    return runs


def matched(rows: DataFrame, distinct: DataFrame, window: int) -> DataFrame:
    """``(key, text_key, windows, offset, first, last)``: the repeated windows of each different segment."""

    def cut(row_id: int, row_hash: int, text: bytes, part: dict) -> Iterator[pa.RecordBatch]:
        ends = part["start"] + part["windows"] + window - 1
        pieces = [text[a:b] for a, b in zip(part["start"].tolist(), ends.tolist(), strict=True)]
        names = [*SEGMENT, "weight"]
        yield pa.RecordBatch.from_arrays([*(pa.array(part[n]) for n in names), pa.array(pieces, pa.binary())], [*names, "piece"])

    kinds = "key long, text_key long, windows int, offset int"
    pieces = fetched(rows, distinct, cut, f"{kinds}, weight long, piece binary")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "key", max(1, SHARD // (2 * window))):
            columns = {name: table.column(name).to_numpy() for name in [*SEGMENT, "weight"]}
            # A text that stands in several equal rows is fetched once per row.
            order = np.lexsort([columns[n] for n in SEGMENT])
            once = np.ones(len(order), dtype=bool)
            once[1:] = np.any([columns[n][order][1:] != columns[n][order][:-1] for n in SEGMENT], axis=0)
            chosen = order[once]
            held = table.column("piece").take(pa.array(chosen)).to_pylist()
            runs = repeated_windows(held, columns["windows"][chosen], columns["weight"][chosen], window)
            at = chosen[[r[0] for r in runs]] if runs else np.zeros(0, dtype=np.int64)
            out = [pa.array(columns[n][at]) for n in SEGMENT]
            first, last = (pa.array([r[i] for r in runs], pa.int64()) for i in (1, 2))
            yield pa.RecordBatch.from_arrays([*out, first, last], [*SEGMENT, "first", "last"])

    ordered = pieces.repartition("key").sortWithinPartitions("key")
    return map_batches(ordered, sort, f"{kinds}, first long, last long")


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_bytes, kept, spans)`` per row: the bytes left after all removals and the removed byte ranges.

    ``spans`` holds maximal ``(start, end)`` ranges. A byte goes if any ``window`` bytes that cover it also start
    anywhere else, in this row or another; repeats are judged on the texts as given. Null text is empty and texts
    shorter than a window keep everything. Equal rows, and rows without an id, are documents of their own: copies of
    each other that lose all windows. An empty table gives no rows; other columns are not read.

    ``docs`` is read once for segments and once each time texts are fetched, so it should be a stored table.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    number = F.col(id_col).cast("long")
    named = docs.select(
        number.alias("doc_id"),
        F.coalesce(number, F.lit(0).cast("long")).alias("row_id"),
        F.xxhash64(text, F.col(id_col).isNull()).alias("row_hash"),
        text.alias("text"),
    )
    long_enough = named.where(F.octet_length("text") >= window)
    rows = compressed(long_enough).drop("doc_id")
    with shuffles_removed(docs.sparkSession):
        filed_at, found = stored_at(filed(long_enough.drop("doc_id"), window), "segments")
        path, candidates = stored_at(repeated(found.select("row_id", "row_hash", F.inline("segments"))), "repeated-segments")
        consumed(docs.sparkSession, filed_at)
        settled = []
        for width in WIDTHS:
            under = candidates.select(*SEGMENT).distinct().groupBy("key").agg(F.count("*").alias("n"))
            crowded = stored(under.where(F.col("n") > MOST_SEGMENTS).select("key"), "crowded-keys")
            if crowded.isEmpty():
                break
            settled.append(stored(candidates.join(crowded, "key", "left_anti"), "repeated-segments"))
            filed_at, again = stored_at(refiled(rows, candidates.join(crowded, "key"), width, window), "segments")
            consumed(docs.sparkSession, path)
            path, candidates = stored_at(repeated(again), "repeated-segments")
            consumed(docs.sparkSession, filed_at)
        settled.append(candidates)
        every = settled[0]
        for more in settled[1:]:
            every = every.unionByName(more)
        different = stored(distinct_segments(every), "different-segments")
        found = stored(matched(rows, different, window), "repeated-windows")
    least = (different.agg(F.sum("weight")).first()[0] or 0) / HOT_SHARE
    hot = F.broadcast(different.where(F.col("weight") > least).select(*SEGMENT))
    # The windows of a segment are fewer than a window's bytes, so those of the few hot segments are few too.
    few = F.broadcast(found.join(hot, SEGMENT, "left_semi"))
    marked = every.join(few, SEGMENT).unionByName(every.join(hot, SEGMENT, "left_anti").join(found, SEGMENT))
    first, last = ((F.col("start") + F.col(name)).alias(name) for name in ("first", "last"))
    ranges = marked.groupBy("row_id", "row_hash").agg(F.collect_set(F.struct(first, last)).alias("hits"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            kept, spans, sizes = [], [], []
            for packed, hits in zip(batch.column(1), batch.column(2), strict=True):
                data = unpacker.decompress(packed.as_py())
                runs: list[list[int]] = []
                for first, last in sorted((h["first"], h["last"] + window) for h in hits.as_py() or ()):
                    if runs and first <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], last)
                    else:
                        runs.append([first, last])
                edges = [0, *(edge for run in runs for edge in run), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                spans.append([{"start": a, "end": b} for a, b in runs])
                sizes.append(len(data))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "kept", "spans"])

    joined = compressed(named).join(ranges, ["row_id", "row_hash"], "left").select("doc_id", "packed", "hits")
    return map_batches(joined, cut, "doc_id long, n_bytes long, kept binary, spans array<struct<start:long,end:long>>")
