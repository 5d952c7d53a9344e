"""Packing by non-negative least squares over the histogram of piece lengths.

Documents are tokenized once and cut at fixed places: whole windows, then half a window, then the rest. Shallow length
combinations that fill a window exactly are enumerated, non-negative least squares says how often each should be
used, the counts are rounded down and what is left is packed greedily, largest first. All of that works on the
histogram, whose size the window bounds. Spark ranks the pieces of each length and looks up each piece's place.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_batches, stored, utf8

WINDOW = 2048
END_ID = 1
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
# Combinations enumerated per length and depth, and the depths.
PARTNERS = 3
DEPTHS = (2, 3, 4, 5, 6)
SOLVER_STEPS = 400
# Pieces of one length are ranked in groups of about this many, so a length most documents have is shared by tasks.
RANKED_ROWS = 100_000
# Words whose ids a worker remembers, and the longest such word in bytes.
REMEMBERED_WORDS = 1_200_000
LONGEST_REMEMBERED = 64
PROBES = (
    "the", "thandion", "a", "xqzvk", "unbelievably", "s", "l", "don", "éàü", "straße", "ñandú", "œuvre",
    "The", "ÉTÉ", "wOrd.", "a,b", "end###", "x$$$,", "l&r;", "12", "a1b22", "(017)", "x.y_z-34@m7.example.com", "“q”", "5²", "½ª", "--", "ß!?",
)
# Letters, single digits, and all else: what the tokenizer takes apart before its model sees it.
RUNS = re.compile(r"[^\W\d_\u00b2\u00b3\u00b9\u00bc-\u00be]+|[\d\u00b2\u00b3\u00b9\u00bc-\u00be]|(?:[^\w\s]|_)+")
# Characters that may join or change others: contractions, special tokens, a capital whose small form is two, controls.
APART = re.compile("['<İ\x00-\x1f\x7f-\xa0]")
MARKS = frozenset([b".", b",", b";", b":", b"!", b"?"])
LAST_PLAIN = "ſ"  # letters up to here are composed and have one lower case
# Byte-level models spell a byte as its own printable character, others as characters from 256 on, in order.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: chr(b) for b in PRINTABLE} | {
    b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(PRINTABLE)))
}


class WordIds(dict):
    """Ids of a word as little-endian 32-bit integers, remembered.

    Valid for tokenizers that never join characters across ASCII white space and drop it, as the default one. At
    loading, probes show whether the tokenizer lower-cases and takes plain words apart into runs of letters, digits
    and other signs, as the default one does; then the ids of a word are those of its runs, which words share, and its
    model alone tokenizes a run of letters. Other tokenizers and other words are tokenized as they stand.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.parts = True
        self.parts = all(self.in_runs(w) in (None, self.packed(self.ids(w))) for w in PROBES)
        self.clear()

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def model_ids(self, word: str) -> list[int]:
        spelled = word if word.isascii() else "".join(map(BYTE_LETTERS.__getitem__, word.encode()))
        return [token.id for token in self.tokenizer.model.tokenize(spelled)]

    def in_runs(self, text: str) -> bytes | None:
        """The ids of a plain word by its runs; nothing for other words."""
        if max(text) > LAST_PLAIN or APART.search(text):
            return None
        runs = RUNS.findall(text.lower())
        if len(runs) > 1:
            return b"".join([self[run.encode()] for run in runs])
        return self.packed(self.model_ids(runs[0]) if runs[0].isalpha() else self.ids(runs[0])) if runs else None

    def __missing__(self, word: bytes) -> bytes:
        found = None
        if self.parts:
            # The commonest words: ASCII letters, and a mark after a letter or digit.
            if word.isalpha():
                low = word.lower()
                found = self[low] if low != word else self.packed(self.model_ids(word.decode()))
            elif word[-1:] in MARKS and word[-2:-1].isalnum():
                found = self[word[:-1]] + self[word[-1:]]
            else:
                found = self.in_runs(word.decode("utf-8", "replace"))
        if found is None:
            found = self.packed(self.ids(word.decode("utf-8", "replace")))
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = found
        return found


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def cuts(tokens: int, window: int) -> list[tuple[int, int]]:
    """``(start, length)`` of a document's pieces: whole windows, then at most one half, then the rest."""
    whole = tokens - tokens % window
    pieces = [(start, window) for start in range(0, whole, window)]
    if tokens - whole > window // 2:
        pieces.append((whole, window // 2))
        whole += window // 2
    if tokens > whole:
        pieces.append((whole, tokens - whole))
    return pieces


def tokenize(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, window: int) -> DataFrame:
    """``(piece, doc_id, start, length, doc_tokens, packed)``; ``packed`` is what ``compressed`` makes of the ids.

    Each document ends with ``end_id``; a null text is empty and has only that. ``piece`` numbers pieces by task and
    position and is meant to be stored before use.
    """
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(tokenizer)
        number = TaskContext.get().partitionId() << 40
        codec = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                ids = b"".join(map(known.__getitem__, text.split())) + end
                tokens = len(ids) // 4
                for start, length in cuts(tokens, window):
                    part = compressed(codec, ids[4 * start : 4 * (start + length)])
                    rows.append((number, doc_id, start, length, tokens, part))
                    number += 1
                held += len(ids)
                if held > 16 << 20:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(
        narrow, run, "piece long, doc_id long, start long, length long, doc_tokens long, packed binary"
    )


def compressed(codec: zstandard.ZstdCompressor, ids: bytes) -> bytes:
    """32-bit ids with their bytes sorted by significance, so that the mostly empty upper ones shrink to nothing."""
    return codec.compress(np.frombuffer(ids, np.uint8).reshape(-1, 4).T.tobytes())


def expanded(pieces: DataFrame) -> DataFrame:
    """``packed`` as ``ids``: little-endian unsigned 32-bit integers."""
    names = ["doc_id", "start", "length", "packed", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):  # ids are several times larger than their packed form
                part = batch.slice(at, 1000)
                planes = (np.frombuffer(codec.decompress(p), np.uint8) for p in part.column(3).to_pylist())
                ids = pa.array([p.reshape(4, -1).T.tobytes() for p in planes], pa.binary())
                columns = [ids if name == "packed" else part.column(i) for i, name in enumerate(names)]
                yield pa.RecordBatch.from_arrays(columns, [name.replace("packed", "ids") for name in names])

    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return map_batches(pieces.select(*names), run, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["piece", "doc_id", "start", "length", "doc_tokens", "packed"]
    kinds = [pa.int64()] * 5 + [pa.binary()]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def combinations(histogram: np.ndarray, window: int) -> np.ndarray:
    """Length combinations that fill the window, one per row, padded with zeros.

    For every length and depth a few partners are taken at golden-ratio steps through the histogram's mass, so common
    lengths are offered as partners as often as they occur; the last length is what fills the window.
    """
    lengths = np.flatnonzero(histogram)
    if not len(lengths):
        return np.zeros((0, max(DEPTHS)), dtype=np.int64)
    mass = np.cumsum(histogram[lengths]) / histogram[lengths].sum()
    found = []
    step = (5**0.5 - 1) / 2
    turn = 0
    for depth in DEPTHS:
        for partner in range(PARTNERS if depth > 2 else 1):
            row = np.zeros((len(lengths), max(DEPTHS)), dtype=np.int64)
            row[:, 0] = lengths
            for place in range(1, depth - 1):
                turn += 1
                at = (np.arange(len(lengths)) * step + turn * step * step + partner / PARTNERS) % 1
                row[:, place] = lengths[np.minimum(np.searchsorted(mass, at), len(lengths) - 1)]
            row[:, depth - 1] = window - row.sum(axis=1)
            last = row[:, depth - 1]
            found.append(row[(last > 0) & (histogram[np.clip(last, 0, len(histogram) - 1)] > 0) & (last < len(histogram))])
    return np.unique(np.sort(np.concatenate(found), axis=1), axis=0)


def repeat_counts(combos: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """How often to use each combination: non-negative least squares against the histogram, accelerated gradient."""
    used = np.ones(len(histogram))
    used[0] = 0  # padding of the combinations

    def lengths_of(x: np.ndarray) -> np.ndarray:
        return np.bincount(combos.ravel(), weights=np.repeat(x, combos.shape[1]), minlength=len(histogram)) * used

    def back(y: np.ndarray) -> np.ndarray:
        return (y * used)[combos].sum(axis=1)

    x = np.full(len(combos), 1.0)
    for _ in range(30):
        x = back(lengths_of(x))
        largest = np.linalg.norm(x)
        x /= max(largest, 1e-30)
    x = np.zeros(len(combos))
    ahead, momentum = x, 1.0
    for _ in range(SOLVER_STEPS):
        better = np.maximum(ahead - back(lengths_of(ahead) - histogram) / max(largest, 1e-30), 0)
        following = (1 + (1 + 4 * momentum * momentum) ** 0.5) / 2
        ahead = better + (momentum - 1) / following * (better - x)
        x, momentum = better, following
    return x


def plan(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[list[int], int]]:
    """``(lengths, times)`` of the sequences that hold exactly the pieces counted in ``histogram``."""
    left = np.asarray(histogram, dtype=np.int64).copy()
    sequences: list[tuple[list[int], int]] = []
    if left[window]:
        sequences.append(([window], int(left[window])))
        left[window] = 0
    combos = combinations(left, window)
    if len(combos):
        wanted = np.floor(repeat_counts(combos, left.astype(float)) + 1e-6).astype(np.int64)
        for row in np.argsort(-wanted, kind="stable"):
            if wanted[row] < 1:
                break
            lengths = [int(n) for n in combos[row] if n]
            times = min(int(wanted[row]), *(int(left[n]) // lengths.count(n) for n in set(lengths)))
            if times:
                sequences.append((lengths, times))
                for n in lengths:
                    left[n] -= times
    open_lengths = np.flatnonzero(left)
    while len(open_lengths):
        lengths, gap = [], window
        taken: dict[int, int] = {}
        at = len(open_lengths) - 1
        while at >= 0 and gap > 0:
            n = int(open_lengths[at])
            if n <= gap and taken.get(n, 0) < left[n]:
                copies = min(gap // n, int(left[n]) - taken.get(n, 0))
                lengths += [n] * copies
                taken[n] = taken.get(n, 0) + copies
                gap -= n * copies
            at = min(at - 1, int(np.searchsorted(open_lengths, gap, side="right")) - 1)
        times = min(int(left[n]) // copies for n, copies in taken.items())
        sequences.append((lengths, times))
        for n, copies in taken.items():
            left[n] -= times * copies
        open_lengths = open_lengths[left[open_lengths] > 0]
    return sequences


def places(sequences: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """``(length, first, after, sequence, offset)``: pieces of a length ranked ``first`` up to ``after`` take the
    sequences from ``sequence`` on, one each, at ``offset``."""
    given: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, times in sequences:
        offset = 0
        for n in lengths:
            first = given.get(n, 0)
            rows.append((n, first, first + times, sequence, offset))
            given[n] = first + times
            offset += n
        sequence += times
    return rows


def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """``(piece, length, rank)``: rank from 0 among the pieces of a length, without holding a length in one task."""
    salts = max(32, -(-total // RANKED_ROWS))
    salted = pieces.select("piece", "length", F.pmod(F.xxhash64("piece"), F.lit(salts)).cast("int").alias("salt"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        salted.groupBy("length", "salt")
        .agg(F.count("*").alias("n"))
        .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("piece")) - 1
    return (
        salted.withColumn("own", own)
        .join(firsts, ["length", "salt"])
        .select("piece", "length", (F.col("own") + F.col("before")).alias("rank"))
    )


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    window: int = WINDOW,
) -> DataFrame:
    """``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)``, one row per piece.

    Every id of every row of ``docs``, repeated rows and rows without an id included, lies in exactly one piece. A
    null or empty text is the end id alone. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    pieces = stored(tokenize(docs, id_col, text_col, tokenizer, end_id, window), "pieces")
    counted = pieces.groupBy("length").agg(F.count("*").alias("n"))
    histogram = np.zeros(window + 1, dtype=np.int64)
    for row in counted.collect():  # at most one row per length up to the window
        histogram[row["length"]] = row["n"]
    found = places(plan(histogram, window))
    # The plan's size depends on the window, not on the data, so it can be sent to every task.
    slots = spark.createDataFrame(found, "length long, first long, after long, sequence long, offset long")
    rank = F.col("rank")
    placed = (
        ranked(pieces, int(histogram.sum()))
        .join(F.broadcast(slots), "length")
        .where((rank >= F.col("first")) & (rank < F.col("after")))
        .select("piece", (F.col("sequence") + rank - F.col("first")).alias("sequence_id"), "offset")
    )
    return expanded(pieces.join(placed, "piece"))
