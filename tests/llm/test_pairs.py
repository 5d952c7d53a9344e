"""Suffix-array deduplication, SimHash near-duplicates and document fingerprints against plain versions."""

import hashlib
import os
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stratalake.llm import doc_fingerprints, queries, simhash_dedup, suffix_dedup
from stratalake.llm import suffix_array as suffix_sorting
from stratalake.llm.common import components
from stratalake.llm.suffix_array import permuted_common_prefixes, suffix_array

SMALL = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="tables not present")
COLUMNS = "doc_id long, text string, lang string, row_id long, row_hash string, fp string, key int, text_key int, next_id int"


def table(spark, texts):
    rows = [(i, t, None, None, None, "x", 1, 2, 3) for i, t in texts]
    return spark.createDataFrame(rows, COLUMNS)


def prose(seed, words):
    chosen = random.Random(seed)
    return " ".join("".join(chosen.choice("abcdeé") for _ in range(chosen.randint(2, 8))) for _ in range(words))


def hard_texts():
    shared = prose(1, 80)
    long_one = prose(2, 9000)
    return [
        (1, shared + prose(3, 100)),
        (2, prose(4, 100) + shared),
        (3, shared),
        (3, shared),
        (None, shared),
        (None, None),
        (4, None),
        (5, ""),
        (6, "a" * 1000),
        (7, long_one),
        (8, long_one[:40_000] + " other " + long_one[40_007:]),
        (9, prose(5, 20)),
        (10, "é" * 300),
    ]


# Suffix arrays


@pytest.mark.parametrize("symbols", [1, 2, 3, 20])
def test_suffix_array_and_prefixes(symbols):
    draw = np.random.default_rng(symbols)
    for size in [0, 1, 2, 5, 30, 200]:
        s = np.append(draw.integers(1, symbols + 1, size), 0)
        text = s.tolist()
        expected = sorted(range(len(text)), key=lambda i: text[i:])
        for few in (True, False):
            assert suffix_array(s, symbols + 1, few).tolist() == expected
        shared = permuted_common_prefixes(s, np.array(expected), 4)
        for a, b in zip(expected, expected[1:], strict=False):
            same = next(k for k in range(size + 2) if text[a + k : a + k + 1] != text[b + k : b + k + 1])
            assert shared[b] == same


def plain_cut(texts, window):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for p in range(len(d) - window + 1):
            seen[d[p : p + window]] = seen.get(d[p : p + window], 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - window + 1):
            if seen[d[p : p + window]] > 1:
                gone[p : p + window] = b"\1" * window
        kept = bytes(c for c, g in zip(d, gone, strict=True) if not g)
        spans = sum(1 for a, b in zip(b"\0" + bytes(gone), bytes(gone), strict=False) if b and not a)
        out.append((len(d), len(d) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def cut_rows(found):
    return [
        (r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest())
        for r in found.collect()
    ]


@pytest.mark.parametrize("most", [4096, 2])
def test_cut_repeats_equals_plain_version(spark, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST_SEGMENTS", most)  # two: anchors are filed again by longer contexts
    texts = hard_texts()
    expected = plain_cut([t for _, t in texts], 400)
    assert sorted(cut_rows(suffix_dedup.cut_repeats(table(spark, texts)))) == sorted(expected)
    assert sum(removed for _, removed, *_ in expected) > 60_000


@pytest.mark.parametrize("share", [1, 4])
def test_cut_repeats_with_few_or_no_hot_keys(spark, monkeypatch, share):
    monkeypatch.setattr(suffix_dedup, "HOT_SHARE", share)
    draw = random.Random(21)
    shared = [bytes(draw.choice(b"abcde ") for _ in range(500)).decode() for _ in range(3)]
    rows = [(i, shared[0] if i % 3 else shared[1 + i % 2] + chr(48 + i)) for i in range(60)] + [(100 + i, f"own {i} " * 90) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in suffix_dedup.cut_repeats(docs).collect()}
    monkeypatch.setattr(suffix_dedup, "HOT_SHARE", 1000)
    usual = {r["doc_id"]: r["spans"] for r in suffix_dedup.cut_repeats(docs).collect()}
    assert found == usual and all([(s["start"], s["end"]) for s in found[i]] == [(0, 500)] for i in range(60))


def test_shards_deal_short_symbols_and_anchors_are_sought_in_small_blocks(monkeypatch):
    """Wide symbols are sorted by comparisons, and blocks beyond a processor's cache cost half as much again."""
    dealt, sought = [], []
    deal, anchors = suffix_sorting._deal, suffix_dedup.anchors

    def counted_deal(sa, fill, found, symbols, sign):
        dealt.append(symbols.dtype.itemsize)
        deal(sa, fill, found, symbols, sign)

    def counted_anchors(data, window):
        sought.append(len(data))
        return anchors(data, window)

    monkeypatch.setattr(suffix_sorting, "_deal", counted_deal)
    monkeypatch.setattr(suffix_dedup, "anchors", counted_anchors)
    draw = np.random.default_rng(5)
    texts = [draw.integers(0, 256, 3_000, dtype=np.uint8).tobytes() for _ in range(100)]
    found = list(suffix_dedup.segments(texts, 400))
    assert sum(part[2].sum() for part in found) == 100 * (3_000 - 400 + 1)
    assert len(sought) > 1 and max(sought) < suffix_dedup.GATHERED + 3_000
    pieces = [texts[0][:700], texts[1][:700], texts[0][100:800]]
    runs = suffix_dedup.repeated_windows(pieces, np.full(3, 301), np.ones(3, dtype=np.int64), 400)
    assert sorted(runs) == [(0, 100, 300), (2, 0, 200)]
    assert dealt and max(dealt) <= 2


def test_cut_repeats_of_nothing(spark):
    assert suffix_dedup.cut_repeats(table(spark, [])).count() == 0
    assert cut_rows(suffix_dedup.cut_repeats(table(spark, [(1, "x")]))) == plain_cut(["x"], 400)


@needs_tables
def test_op1_on_tables(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()
    found = queries.op1_suffix_array_dedup(spark, SMALL).drop("doc_id").collect()
    assert sorted(map(tuple, found)) == sorted(plain_cut([r["text"] for r in rows], 400))


# SimHash near-duplicates


def plain_fingerprint(text):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=3):
    prints = [plain_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                label[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(
        ((doc_id, prints[i], least.get(root(i))) for i, (doc_id, _) in enumerate(rows)), key=repr
    )


def found_components(found):
    return sorted(((r[0], r[1] & (1 << 64) - 1, r[2]) for r in found.collect()), key=repr)


def near_texts():
    base = prose(6, 400).split()
    rows = [(i, " ".join(base[: 200 + i] + ["changed"] * (i % 3) + base[201 + i :])) for i in range(40)]
    return hard_texts() + [(100 + i, t) for i, t in rows] + [(None, "A B"), (200, "a b"), (201, "a\tB\n")]


@pytest.mark.parametrize("piece", [4096, 3])
def test_near_duplicates_equal_plain_version(spark, monkeypatch, piece):
    monkeypatch.setattr(simhash_dedup, "PIECE", piece)  # three: crowded keys are compared in pieces
    rows = near_texts()
    assert found_components(simhash_dedup.near_duplicates(table(spark, rows))) == plain_components(rows)


def test_near_duplicates_of_nothing(spark):
    assert simhash_dedup.near_duplicates(table(spark, [])).count() == 0


@needs_tables
def test_op2_on_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op2_simhash_near_dedup(spark, SMALL).collect()
    expected = [(i, f"{fp:016x}", c) for i, fp, c in plain_components(rows)]
    assert sorted(map(tuple, found)) == sorted(expected)


def test_link_groups_connect_all_near_pairs():
    draw = np.random.default_rng(3)
    centre = draw.integers(0, 1 << 63, 1, dtype=np.uint64)
    flips = np.array([np.bitwise_or.reduce(np.uint64(1) << draw.integers(0, 64, 3, dtype=np.uint64)) for _ in range(200)])
    fps = np.unique(centre ^ flips)
    a, b = simhash_dedup.link_groups(np.zeros(len(fps), dtype=np.int64), fps, 3)
    assert len(a) < len(fps) and (np.bitwise_count(a ^ b) <= 3).all()
    joined = {int(f): {int(f)} for f in fps}
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        both = joined[x] | joined[y]
        for node in both:
            joined[node] = both
    for i in range(len(fps)):
        for j in range(i):
            if int(fps[i] ^ fps[j]).bit_count() <= 3:
                assert joined[int(fps[i])] is joined[int(fps[j])]


def test_components_of_chain_star_and_nothing(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 30)] + [(7, 7)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 5 for i in range(5, 30)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_deduplicate_keeps_one_row_each(spark):
    docs = table(spark, [(2, "a b c"), (1, "A b c"), (1, "a b c"), (3, "x y z"), (None, "a b c")])
    kept = simhash_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]
    assert simhash_dedup.deduplicate(docs.limit(0)).count() == 0


def test_deduplicate_of_rows_without_id_and_of_rows_with_other_columns(spark):
    one, other = prose(24, 60), prose(25, 60)
    rows = [(None, one, "b"), (None, one, "a"), (None, one, "a"), (None, other, "c"), (3, other, "e"), (3, other, "d")]
    seen = set()
    for docs in (rows, rows[::-1]):
        found = simhash_dedup.deduplicate(spark.createDataFrame(docs, "doc_id long, text string, kept_id string"))
        seen.add(tuple(sorted((r["doc_id"] or 0, r["text"], r["kept_id"]) for r in found.collect())))
    (kept,) = seen
    assert sorted(k[:2] for k in kept) == sorted([(0, one), (3, other)])


def test_deduplicate_keeps_unlike_texts_of_one_id(spark):
    one, other, third = prose(21, 60), prose(22, 60), prose(23, 60)
    rows = [(1, one), (1, other), (1, other), (2, other), (5, third), (4, third), (4, third + " "), (0, one), (7, None), (7, "")]
    kept = [(r["doc_id"], (r["text"] or "").strip()) for r in simhash_dedup.deduplicate(table(spark, rows)).collect()]
    assert sorted(kept) == sorted([(0, one), (1, other), (4, third), (7, "")])


# Document fingerprints


def test_edited_texts_equal_plain_version(spark):
    rows = [(5, "abcdefgh"), (1, "é😀xyzé😀xyz"), (9, "q"), (7, None), (8, "0123456789" * 50), (None, "nameless")]
    found = {r["doc_id"]: (r["text"], r["edited"]) for r in doc_fingerprints.edited_texts(table(spark, rows)).collect()}
    named = sorted((i, t or "") for i, t in rows if i is not None)
    for at, (doc_id, text) in enumerate(named):
        following = named[(at + 1) % len(named)][1]
        share = len(text) // 4
        assert found[doc_id] == (text, text[: len(text) - share] + following[:share])
    assert found[None] == ("nameless", "namele" + "na")


def test_edited_fingerprints_of_repeated_rows_and_nothing(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (100, "a b c d"), (2, ""), (None, None), (200, "other words here")]
    found = doc_fingerprints.edited_fingerprints(table(spark, rows)).collect()
    assert sorted((r["doc_id"] for r in found), key=repr) == sorted((i for i, _ in rows), key=repr)
    same = {r["fp"] for r in found if r["n_chars"] == 7}
    assert len(same) == 1
    within = {r["doc_id"]: r["n_within"] for r in found}
    assert within[100] == 3 and within[200] == 1 and within[1] is None
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)
    assert doc_fingerprints.edited_fingerprints(table(spark, [])).count() == 0


def test_votes_of_many_copies_do_not_overflow(spark):
    one = spark.range(1).select(F.lit(1).alias("k"), F.repeat(F.lit("x"), F.lit(200_000)).alias("text"))
    copies = spark.range(0, 12_000, 1, 8).select(F.lit(1).alias("k"), F.repeat(F.lit("x"), F.lit(200_000)).alias("text"))
    (alone,), (many,) = (doc_fingerprints.votes(rows, ["k"], "text").collect() for rows in (one, copies))
    assert (alone["copies"], many["copies"], many["fp"]) == (1, 12_000, alone["fp"])


@pytest.mark.parametrize("radius", [0, 3, 6])
def test_block_tables_find_all_within_radius(spark, radius):
    draw = random.Random(radius)
    base = [draw.getrandbits(64) for _ in range(40)]
    near = [b ^ sum(1 << k for k in draw.sample(range(64), draw.randint(0, radius + 2))) for b in base for _ in range(5)]
    values = sorted({v - (1 << 64) if v >> 63 else v for v in base + near})
    prints = spark.createDataFrame([(v,) for v in values], "fp long")
    found = sorted(tuple(r) for r in doc_fingerprints.within(prints, prints, radius).collect())
    mask = (1 << 64) - 1
    expected = sorted(
        (a, b, ((a ^ b) & mask).bit_count()) for a in values for b in values if ((a ^ b) & mask).bit_count() <= radius
    )
    assert found == expected


@needs_tables
def test_op8_on_tables(spark):
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    found = {r["doc_id"]: r for r in queries.op8_document_fingerprints(spark, SMALL).collect()}
    assert len(found) == len(rows)
    for at, (doc_id, text) in enumerate(rows):
        following = rows[(at + 1) % len(rows)][1]
        edited = text[: len(text) - len(text) // 4] + following[: len(text) // 4]
        assert found[doc_id]["n_chars"] == len(text)
        assert found[doc_id]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    edited = [r["near_edited"] for r in found.values()]
    others = [r["near_next"] for r in found.values()]
    assert np.mean(edited) > 0.7 and np.mean(others) < 0.6
