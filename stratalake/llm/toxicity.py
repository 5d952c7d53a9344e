"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length, with exception phrases.

Lexicon, exceptions and calibration are learned from a bounded sample of labelled rows; every text is scored whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stored

# Labelled ids of each class, in expectation, that the lexicon and the calibration are learned from, one text of each.
ROWS_PER_CLASS = 10_000
# Of these, the share the lexicon is learned from; the rest calibrates.
LEXICON_SHARE = 0.7
# A lexicon entry is in at least this many and this share of the toxic texts, and this much likelier (logarithm)
# there than in clean ones. The share bounds the lexicon: the sample's terms over the texts an entry needs.
MIN_TEXTS = 3
MIN_SHARE = 0.002
MIN_LOG_ODDS = 2.5
# Words longer than this also count by their beginning, so inflected forms share an entry.
STEM = 5
# An exception phrase is in at least this many clean texts and in under this share of toxic ones.
EXCEPTION_TEXTS = 5
EXCEPTION_SHARE = 0.1

# Letters that look like Latin ones, and digits and signs written for letters.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "к": "k",
    "м": "m", "т": "t", "н": "h", "в": "b", "α": "a", "ο": "o", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x",
}
SUBSTITUTES = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i",
}
# Phrases in which a lexicon word is no insult.
EXCEPTIONS = ("trash can", "trash bin", "sore loser", "clown fish", "class clown", "pond scum", "stupid question")


class Folding(dict):
    """For ``str.translate``: every character to a lower-case Latin-looking letter, or a blank."""

    def __missing__(self, code: int) -> str:
        char = chr(code).lower()
        if 0xFF01 <= code <= 0xFF5E:  # full-width forms of ASCII
            char = chr(code - 0xFEE0).lower()
        char = HOMOGLYPHS.get(char, char)
        self[code] = char if char.isalpha() else " "
        return self[code]


FOLDING = Folding()
INSIDE_WORDS = str.maketrans(SUBSTITUTES)


def fold(text: str) -> list[str]:
    """The folded words of a text. Digits and signs count as letters in words that have a letter, not at their end."""
    if not text.isascii() or any(mark in text for mark in SUBSTITUTES):
        parts = []
        for word in text.split():
            if not word.isalpha():
                core = word.rstrip("!.,;:?")
                if any(c.isalpha() for c in core):
                    word = core.translate(INSIDE_WORDS)
            parts.append(word)
        text = " ".join(parts)
    return text.translate(FOLDING).split()


def terms(words: list[str]) -> set[str]:
    """Lexicon entries a text could match: words with a blank on both sides, beginnings with one before."""
    distinct = set(words)
    return {f" {w} " for w in distinct} | {f" {w[:STEM]}" for w in distinct if len(w) > STEM}


@dataclass(frozen=True)
class Model:
    """``weights`` by entry, ``exceptions`` as phrases, ``coefficients`` of the calibration."""

    weights: dict[str, float]
    exceptions: frozenset[str]
    coefficients: tuple[float, ...]

    def automaton(self) -> ahocorasick.Automaton:
        machine = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            machine.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            machine.add_word(f" {phrase} ", (len(phrase) + 2, 0.0))
        if len(machine):
            machine.make_automaton()
        return machine


def matches(machine: ahocorasick.Automaton, words: list[str]) -> tuple[dict[int, float], str]:
    """Weight by position of each word the lexicon hits outside exception phrases, and the text searched."""
    line = f" {' '.join(words)} "
    hits: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    if len(machine):
        for end, (size, weight) in machine.iter(line):
            start = end - size + 1
            if weight:
                hits[start] = max(hits.get(start, 0.0), weight)
            else:
                excused.append((start, end))
    for start, end in excused:
        for at in [h for h in hits if start <= h < end]:
            del hits[at]
    return hits, line


def features(hits: dict[int, float], words: int) -> tuple[float, float, float]:
    """Constant, weight per hundred words, and the logarithm of the total weight."""
    total = sum(hits.values())
    return 1.0, min(100 * total / (words + 5), 100.0), float(np.log1p(total))


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows_per_class: int) -> Model:
    """Learn from ``labels`` ``(id, 0 or 1)``; a random sample of about ``rows_per_class`` ids of each class is used.

    An id labelled both 0 and 1 counts as 1; of an id that stands on several texts, the one of least hash is read.
    Without labelled rows of both classes the model knows no words and scores everything 0.5 less a little.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).select(
        F.col(id_col).cast("long").alias("labelled"), F.col(label_col).cast("int").alias("toxic")
    )
    known = known.groupBy("labelled").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return Model({}, frozenset(EXCEPTIONS), (-0.1, 0.0, 0.0))
    shares = {c: min(1.0, rows_per_class / n) for c, n in counts.items()}
    draw = F.pmod(F.xxhash64("labelled"), F.lit(1_000_000)) / 1_000_000
    fraction = F.when(F.col("toxic") == 1, F.lit(shares[1])).otherwise(F.lit(shares[0]))
    side = F.pmod(F.xxhash64("labelled", F.lit("side")), F.lit(1000)) < int(1000 * LEXICON_SHARE)
    chosen = known.where(draw < fraction).select("labelled", "toxic", side.alias("learn"))
    # The sample is bounded by the parameter, so it can be sent to every task.
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    drawn = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    one = drawn.groupBy("doc_id", "toxic", "learn").agg(least).select("toxic", "learn", "least.text")
    sample = stored(one.repartition(32), "toxicity-sample")
    learning = sample.where("learn").select("toxic", "text")
    calibrating = sample.where("not learn").select("toxic", "text")
    totals = {r["toxic"]: r["n"] for r in learning.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic_texts, clean_texts = totals.get(1, 0), totals.get(0, 0)

    def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[toxic].update(terms(fold(text or "")))
        # A term that no toxic text of this part has can still be an entry elsewhere, so clean counts go along.
        every = list(seen[0].keys() | seen[1].keys())
        for at in range(0, len(every), 50_000):
            part = every[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array([seen[1][t] for t in part]), pa.array([seen[0][t] for t in part])],
                ["term", "toxic", "clean"],
            )

    counted = map_batches(learning, count_terms, "term string, toxic long, clean long")
    odds = F.log((F.col("toxic") + 0.5) / (toxic_texts + 1.0)) - F.log((F.col("clean") + 0.5) / (clean_texts + 1.0))
    entries = (
        counted.groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((F.col("toxic") >= max(MIN_TEXTS, MIN_SHARE * toxic_texts)) & (odds >= MIN_LOG_ODDS))
        .select("term", odds.alias("weight"))
    )
    weights = {r["term"]: r["weight"] for r in entries.collect()}
    bare = Model(weights, frozenset(EXCEPTIONS), (0.0, 0.0, 0.0))

    def count_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = bare.automaton()
        seen = (Counter(), Counter())
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hits, line = matches(machine, fold(text or ""))
                near = set()
                for at in hits:
                    end = line.index(" ", at + 1)
                    word, before = line[at + 1 : end], line[line.rfind(" ", 0, at) + 1 : at]
                    after = line[end + 1 : max(line.find(" ", end + 1), end)]
                    near |= {f"{before} {word}", f"{word} {after}"}
                seen[toxic].update(p.strip() for p in near if " " in p.strip())
        every = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(every, pa.string()), pa.array([seen[1][t] for t in every], pa.int64()), pa.array([seen[0][t] for t in every], pa.int64())],
            ["phrase", "toxic", "clean"],
        )

    phrases = (
        map_batches(learning, count_phrases, "phrase string, toxic long, clean long")
        .groupBy("phrase")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((F.col("clean") >= EXCEPTION_TEXTS) & (F.col("toxic") <= EXCEPTION_SHARE * F.col("clean")))
    )
    learned = Model(weights, frozenset(EXCEPTIONS) | {r["phrase"] for r in phrases.collect()}, (0.0, 0.0, 0.0))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = learned.automaton()
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                words = fold(text or "")
                rows.append(features(matches(machine, words)[0], len(words)))
            table = np.array(rows, dtype=float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(table[:, 1]), pa.array(table[:, 2])], ["toxic", "x1", "x2"])

    seen = map_batches(calibrating, measure, "toxic int, x1 double, x2 double").collect()
    table = np.array(sorted((r["toxic"], 1.0, r["x1"], r["x2"]) for r in seen), dtype=float).reshape(-1, 4)
    per_row = np.where(table[:, 0] == 1, 1 / shares[1], 1 / shares[0])
    return Model(weights, learned.exceptions, tuple(logistic(table[:, 1:], table[:, 0], per_row)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Coefficients of a weighted logistic regression by Newton's method; the ridge keeps separable data finite."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge * beta
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(curvature, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, n_hits)`` per row: the calibrated probability of label 1, from the text alone.

    Null text is empty; repeated rows and rows without an id are each scored. An empty table gives no rows; other
    columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.automaton()
        beta = np.array(model.coefficients)
        for batch in batches:
            scores, counts = [], []
            for text in batch.column(1):
                words = fold(text.as_py() or "")
                hits, _ = matches(machine, words)
                scores.append(1 / (1 + np.exp(-np.clip(np.dot(features(hits, len(words)), beta), -30, 30))))
                counts.append(len(hits))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(counts, pa.int64())], ["doc_id", "score", "n_hits"]
            )

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(narrow, run, "doc_id long, score double, n_hits long")


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows_per_class: int = ROWS_PER_CLASS,
) -> DataFrame:
    """``score`` with a model learned from ``labels``, a table with the documents' ids and 0 or 1."""
    model = fit(docs, labels, id_col, text_col, label_col, rows_per_class)
    return score(docs, model, id_col, text_col)
