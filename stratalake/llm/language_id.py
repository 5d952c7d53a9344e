"""Language ID: averaged hashed subword embeddings under a linear softmax, with calibrated rejection.

A text is the mean embedding of its letter n-grams of two to four characters, word edges included. Embeddings and
softmax are trained by stochastic gradient descent in numpy on a bounded sample of labelled rows; Spark takes the
sample, counts its n-grams and applies the model to every whole text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

UNDETERMINED = "und"
# Labelled rows of each language, at most, that the model is fitted on; a fifth of them calibrates.
ROWS_PER_LANGUAGE = 600
BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
SIZES = (2, 3, 4)
DIMENSIONS = 16
EPOCHS = 6
RATE = 0.5
SEED = 7
# Share of rightly recognised calibration texts that rejection may cost, and the most it may ask of a score.
REJECTED_SHARE = 0.002
HIGHEST_THRESHOLD = 0.5
# Characters handled at once.
BLOCK = 1 << 18
SPACE = 32
MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def ngram_buckets(codes: np.ndarray, starts: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(position, bucket)`` of the n-grams of each size that begin before ``starts`` and hold no inner space.

    ``codes`` are lower-case code points with everything but letters replaced by a space.
    """
    space = codes == SPACE
    hashed = codes.astype(np.uint64)
    grown = hashed
    inner = np.zeros(len(codes), dtype=bool)
    for size in range(2, max(SIZES) + 1):
        if len(codes) < size:
            return
        if size > 2:
            inner = inner[: len(codes) - size + 1] | space[size - 2 : len(codes) - 1]
        else:
            inner = (space[:-1] & space[1:])[: len(codes) - 1]
        grown = grown[: len(codes) - size + 1] * MULTIPLIERS[0] + hashed[size - 1 :]
        if size in SIZES:
            at = np.flatnonzero(~inner[:starts])
            mixed = (grown[at] ^ np.uint64(size)) * MULTIPLIERS[1]
            yield at, (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def blocks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """``(codes, owner, starts)``: texts laid side by side in blocks; ``owner`` is the text of each position.

    A longer text runs on in the next block, which repeats the characters an n-gram may still need.
    """
    overlap = max(SIZES) - 1
    pieces: list[str] = []
    owners: list[int] = []
    held = 0

    def laid(starts_short: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        codes = np.frombuffer(" ".join(pieces).encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
        sizes = [len(p) + 1 for p in pieces]
        sizes[-1] -= 1
        owner = np.repeat(np.array(owners), sizes)
        codes = np.where(letters()[codes], codes, SPACE)
        return codes, owner, len(codes) - starts_short

    for number, text in enumerate(texts):
        text = text or ""
        for at in range(0, len(text), BLOCK):
            more = at + BLOCK < len(text)
            ahead = f"{text[at + BLOCK : at + BLOCK + overlap].lower()} "[:overlap] if more else ""
            piece = text[at : at + BLOCK].lower()
            pieces.append(f"{'' if at else ' '}{piece}{ahead or ' '}")
            owners.append(number)
            held += len(piece)
            if more or held >= BLOCK:
                yield laid(len(ahead))
                pieces, owners, held = [], [], 0
    if pieces:
        yield laid()


@dataclass(frozen=True)
class Model:
    """``logits`` per bucket and language; a text's are their mean over its n-grams plus ``bias``."""

    languages: tuple[str, ...]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """``(per text and language, whether the text has a letter)``."""
        count = len(texts)
        sums = np.zeros((count, len(self.languages)))
        grams = np.zeros(count)
        lettered = np.zeros(count, dtype=bool)
        for codes, owner, starts in blocks(texts):
            lettered |= np.bincount(owner, weights=codes != SPACE, minlength=count) > 0
            for at, bucket in ngram_buckets(codes, starts):
                whose = owner[at]
                grams += np.bincount(whose, minlength=count)
                for k in range(len(self.languages)):
                    sums[:, k] += np.bincount(whose, weights=self.logits[bucket, k], minlength=count)
        return softmax((sums / np.maximum(grams, 1)[:, None] + self.bias) / self.temperature), lettered

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; without a letter or without known languages undetermined, at 0."""
        if not self.languages or not texts:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        shares, lettered = self.probabilities(texts)
        best = shares.argmax(axis=1)
        names = [self.languages[b] if known else UNDETERMINED for b, known in zip(best, lettered, strict=True)]
        return names, np.where(lettered, shares.max(axis=1), 0.0)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def counted(texts: list[str | None]) -> list[tuple[bytes, bytes]]:
    """Buckets (16 bits) and counts (32 bits) of each text's n-grams."""
    table = [np.zeros(BUCKETS, dtype=np.uint32) for _ in texts]
    for codes, owner, starts in blocks(texts):
        for at, bucket in ngram_buckets(codes, starts):
            whose = owner[at]
            for number in np.unique(whose):
                table[number] += np.bincount(bucket[whose == number], minlength=BUCKETS).astype(np.uint32)
    found = [np.flatnonzero(row) for row in table]
    return [(ids.astype("<u2").tobytes(), row[ids].astype("<u4").tobytes()) for ids, row in zip(found, table, strict=True)]


def train(rows: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """A model from ``(language, buckets, counts)`` rows, in the order given; every fifth row of a language
    calibrates. Without five of any language all rows learn and calibrate."""
    names = tuple(sorted({r[0] for r in rows}))
    index = {name: k for k, name in enumerate(names)}
    samples = [(index[name], ids, n / n.sum()) for name, ids, n in rows if len(ids)]
    if not samples:
        return Model((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    learning, calibrating = [], []
    rows_of = [0] * len(names)
    for sample in samples:
        rows_of[sample[0]] += 1
        (learning if rows_of[sample[0]] % 5 else calibrating).append(sample)
    calibrating = calibrating or samples
    random = np.random.default_rng(SEED)
    table = random.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    output = random.normal(0, 0.1, (DIMENSIONS, len(names)))
    bias = np.zeros(len(names))
    steps = max(1, EPOCHS * len(learning))
    done = 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(learning)):
            truth, ids, share = learning[i]
            rate = RATE * (1 - done / steps)
            mean = share @ table[ids]
            wrong = softmax((mean @ output + bias)[None, :])[0]
            wrong[truth] -= 1
            back = output @ wrong
            output -= rate * np.outer(mean, wrong)
            bias -= rate * 0.1 * wrong
            table[ids] -= (rate * len(ids) / 10) * np.outer(share, back)
            done += 1
    logits = table @ output
    truth = np.array([s[0] for s in calibrating])
    raw = np.array([s[2] @ logits[s[1]] for s in calibrating]) + bias
    heats = np.geomspace(0.05, 20, 60)
    losses = [-np.log(np.maximum(softmax(raw / t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in heats]
    temperature = float(heats[int(np.argmin(losses))])
    shares = softmax(raw / temperature)
    right = shares.max(axis=1)[shares.argmax(axis=1) == truth]
    threshold = min(HIGHEST_THRESHOLD, float(np.quantile(right, REJECTED_SHARE))) if len(right) else 0.0
    return Model(names, logits, bias, temperature, threshold)


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
) -> Model:
    """Learn from the rows of ``docs`` with a language: of each the ``rows_per_language`` distinct ``(id, text)`` of
    least hash. Only where fewer are distinct, copies fill up, the second of each row before the third.

    Rows without language are not used; without any, the model knows no language and rejects everything.
    """
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    known = docs.where(F.col(lang_col).isNotNull()).select(
        F.xxhash64(F.col(id_col), text_hash).alias("draw"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    totals = known.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n")).collect()
    if not totals:
        return train([])
    # Hashes are even, so the least ones lie under a bound that a rough count of distinct rows gives; only those are
    # made distinct and sent here. The bound leaves ten standard deviations and a fifth of the count as room.
    room = (rows_per_language + 10 * rows_per_language**0.5 + 10) / 0.8
    bounds = F.create_map(*[F.lit(x) for r in totals for x in (r["lang"], min(2.0, room / r["n"]))])
    low = known.where(F.shiftrightunsigned("draw", 1) / 2.0**63 < bounds[F.col("lang")])
    by_language: dict[str, list[tuple[int, int, int]]] = {}
    for r in low.groupBy("lang", "draw").agg(F.count("*").alias("copies")).collect():
        for copy in range(min(r["copies"], rows_per_language)):
            by_language.setdefault(r["lang"], []).append((copy, r["draw"] % (1 << 64), r["draw"]))
    drawn = Counter(
        (lang, draw) for lang, rows in by_language.items() for _, _, draw in sorted(rows)[:rows_per_language]
    )
    named = docs.sparkSession.createDataFrame(sorted(drawn), "lang string, draw long")
    chosen = low.join(F.broadcast(named), ["lang", "draw"]).select("draw", "text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # of drawn rows, so bounded
        for batch in batches:
            fresh = []
            for at, row in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                if row not in seen:
                    seen.add(row)
                    fresh.append(at)
            batch = batch.take(pa.array(fresh, pa.int64()))
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), 100):
                found = counted(texts[at : at + 100])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, 100),
                        batch.column(2).slice(at, 100),
                        pa.array([f[0] for f in found], pa.binary()),
                        pa.array([f[1] for f in found], pa.binary()),
                    ],
                    ["draw", "lang", "ids", "counts"],
                )

    tables = map_batches(chosen, count, "draw long, lang string, ids binary, counts binary")
    sample = tables.dropDuplicates(["draw", "lang"]).collect()
    ordered = sorted(sample, key=lambda r: (r["draw"], r["lang"], bytes(r["ids"]), bytes(r["counts"])))
    rows = [(r["lang"], np.frombuffer(r["ids"], "<u2"), np.frombuffer(r["counts"], "<u4")) for r in ordered for _ in range(drawn[r["lang"], r["draw"]])]
    return train(rows)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` per row, from the text alone.

    Null texts and texts without a letter are undetermined at score 0; repeated rows and rows without an id are each
    judged. An empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = model.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(narrow, run, "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` the model does not reject, with all their columns: a text is rejected if undetermined or
    if its score is under the calibrated threshold."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = model.predict(batch.column(place).to_pylist())
            kept = (np.array(names, dtype=object) != UNDETERMINED) & (scores >= model.threshold)
            yield batch.filter(pa.array(kept, pa.bool_()))

    return map_batches(docs, run, docs.schema)
