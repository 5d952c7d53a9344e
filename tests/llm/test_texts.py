"""URL filters, language ID, decontamination, packing, toxicity, chat formatting, PII and the pipeline."""

import hashlib
import os
import random
import re
import struct
import time
import zlib
from collections import defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stratalake.llm import chat, decontamination, language_id, packing, pii, queries, toxicity, url_filters

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="tables not present")
# Extra columns that share names with the operators' own.
COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, score string, words string, piece string,"
    " kind string, base string, leaked_hash string, seed string, key string, length string"
)


def table(spark, texts, langs=None):
    langs = langs or [None] * len(texts)
    rows = [(i, t, lang, None, None, *"abcdefghi") for (i, t), lang in zip(texts, langs, strict=True)]
    return spark.createDataFrame(rows, COLUMNS)


def read(spark, name, folder=SMALL):
    return spark.read.parquet(f"{folder}/{name}.parquet")


# URL filters


def test_parts_of_urls_and_fixed_rules(spark):
    expected = {
        None: ("", "", None),
        "": ("", "", None),
        "no scheme/com/fr/": ("", "", None),
        "HTTP://A.ORG": ("a.org", "", None),
        "http://É.ORG/": ("É.org", "/", "org/"),
        "http://x.ORG/es/": ("x.org", "/es/", "org/"),
        "http://example.org/es/1?u=http://y/z": ("example.org", "/es/1", "example.org/es/"),
        "https://s.example.org/en/12?x#y": ("s.example.org", "/en/12", "example.org/en/1"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/"),
        "a://b://c.com/de/": ("b:", "//c.com/de/", None),
        "http://com/fr/x": ("com", "/fr/x", "com/fr/"),
        "http://q.com:80/fr/": ("q.com:80", "/fr/", None),
        "http://q.com?/fr/": ("q.com", "", None),
        "x\n://q.com/de/\n#": ("q.com", "/de/\n", "com/de/"),
    }
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(expected)], "page_id long, url string, row string")
    none = spark.createDataFrame([], "doc_id long, verdict string")
    found = url_filters.judge(pages, none, queries.URL_RULES).collect()
    assert {r["url"]: (r["host"], r["path"], r["rule"]) for r in found} == expected
    blocked = {r["url"] for r in found if r["verdict"] == "block"}
    assert blocked == {u for u, (_, _, rule) in expected.items() if rule in ("example.org/es/", "example.org/en/1", "com/de/")}
    assert url_filters.judge(pages.limit(0), none, queries.URL_RULES).count() == 0


def plain_rules(rows, least, confidence):
    """Every token set with enough rows of one verdict and enough confidence."""
    count, by_verdict = defaultdict(int), defaultdict(int)
    for tokens, verdict in rows:
        for size in range(1, len(tokens) + 1):
            for some in combinations(sorted(tokens), size):
                count[some] += 1
                by_verdict[some, verdict] += 1
    return {
        (some, verdict): n / count[some]
        for (some, verdict), n in by_verdict.items()
        if n >= least and n / count[some] >= confidence
    }


def test_mined_rules_and_their_use_equal_plain_version(spark):
    draw = random.Random(4)
    rows = []
    for _ in range(300):
        tokens = sorted({draw.choice("abcdef") for _ in range(4)})
        bad = {"a", "b"} <= set(tokens) or "f" in tokens and draw.random() < 0.5
        rows.append((tokens, "block" if bad else "allow"))
    labelled = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    mined = url_filters.mined_rules(labelled, min_support=0.01, min_rows=5, min_confidence=0.9)
    expected = plain_rules(rows, 5, 0.9)
    found = {(tuple(r["tokens"]), r["verdict"]): r["confidence"] for r in mined.collect()}
    assert found.keys() == expected.keys() and all(abs(found[k] - expected[k]) < 1e-9 for k in found)
    frequency = {t: sum(t in tokens for tokens, _ in rows) for t in "abcdef"}
    for r in mined.collect():
        assert r["rarest"] == min(r["tokens"], key=lambda t: (frequency[t], t))
    pages = spark.createDataFrame([(str(i), t) for i, (t, _) in enumerate(rows)], "row string, tokens array<string>")
    got = {r["row"]: r["mined"] for r in url_filters.predicted(pages, mined).collect()}
    support = {(some, v): sum(set(some) <= set(t) and v == w for t, w in rows) for some, v in expected}
    for i, (tokens, _) in enumerate(rows):
        fits = [k for k in expected if set(k[0]) <= set(tokens)]
        best = max(fits, key=lambda k: (round(expected[k], 9), support[k], len(k[0]), k[1]), default=(None, None))
        assert got.get(str(i)) == best[1]


@needs_tables
def test_op3_hosts_paths_and_rules(spark):
    found = queries.op3_url_filters(spark, MIDDLE).collect()
    assert len(found) == read(spark, "pages", MIDDLE).count()
    for r in found:
        rules = [x for x in queries.URL_RULES if (r["host"] == x[1] or r["host"].endswith("." + x[1])) and r["path"].startswith(x[2])]
        best = max(rules, key=lambda x: len(x[1] + x[2]), default=None)
        assert r["rule"] == (best and best[1] + best[2])
        assert best is None or r["verdict"] == best[0]


def test_rare_blocked_host_is_blocked_whatever_the_input_size(spark):
    for total in (500, 20_000):
        urls = [(i, f"http://{'hot' if i % 3 else f'site{chr(97 + i % 7)}'}.net/{'abcde'[i % 5]}/{i}", "allow") for i in range(total)]
        urls += [(total + i, f"http://rare.org/{part}/{i}", "block") for i, part in enumerate("ab")]
        labels = spark.createDataFrame([(i, v) for i, _, v in urls], "doc_id long, verdict string")
        asked = [(-1, "http://rare.org/new/1"), (-2, "http://hot.net/a/1"), (-3, "http://other.org/a/1")]
        pages = spark.createDataFrame([(i, u) for i, u, _ in urls] + asked, "page_id long, url string")
        found = {r["page_id"]: r["verdict"] for r in url_filters.judge(pages, labels, []).collect()}
        assert [found[i] for i in (-1, -2)] == ["block", "allow"]
        assert all(found[i] == v for i, _, v in urls)


def test_rows_a_rule_needs_are_not_rounded_up(spark):
    rows = [(["x"], "block")] * 3 + [(["y"], "allow")] * 184  # 3 / 187 * 187 is a little more than 3
    labelled = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    assert url_filters.mined_rules(labelled, min_rows=3).where("verdict = 'block'").count() == 1


def test_telling_rules_are_the_shortest_of_the_plain_ones(spark):
    draw = random.Random(6)
    rows = []
    for number in range(400):
        tokens = sorted({draw.choice("abcdefgh") for _ in range(4)})
        bad = "a" in tokens or {"b", "c"} <= set(tokens) or "f" in tokens and draw.random() < 0.5
        rows.append((f"u{number}", tokens, "block" if bad else "allow"))
    labelled = spark.createDataFrame([*rows, *rows], "url string, tokens array<string>, verdict string")
    found = {tuple(r["tokens"]): r["confidence"] for r in url_filters.telling_rules(labelled).collect()}
    plain = {t: c for (t, v), c in plain_rules([(t, v) for _, t, v in rows], 10, 0.9).items() if v == "block"}
    assert {("a",), ("b", "c")} <= found.keys() <= plain.keys()
    assert all(abs(found[t] - plain[t]) < 1e-9 for t in found)
    for rule, confidence in plain.items():  # whatever is left out has a part that decides alone or as surely
        parts = [t for t in found if set(t) <= set(rule)]
        assert any(len(t) == 1 or found[t] >= confidence - 1e-9 for t in parts)


def test_urls_of_many_tokens_end(spark):
    letters = [chr(97 + i) + chr(97 + j) for i in range(6) for j in range(5)]
    same = [(i, "http://x.net/" + "/".join(letters), "block") for i in range(1000)]
    draw = random.Random(3)
    dense = [(2000 + i, "http://y.net/" + "/".join(t for t in letters if draw.random() < 0.9) + f"/{i}", "block" if i % 2 else "allow") for i in range(400)]
    urls = same + dense
    pages = spark.createDataFrame([(i, u) for i, u, _ in urls], "page_id long, url string")
    labels = spark.createDataFrame([(i, v) for i, _, v in urls], "doc_id long, verdict string")
    begun = time.time()
    found = {r["page_id"]: r["verdict"] for r in url_filters.judge(pages, labels, []).collect()}
    assert len(found) == len(urls) and time.time() - begun < 120
    # One labelled URL is no rule, however many pages have it.
    assert found[0] in ("allow", "block") and len({found[i] for i, _, _ in same}) == 1


@needs_tables
@pytest.mark.parametrize("folder", [MIDDLE, "/root/testdata/sf0.1"])
def test_op3_blocks_every_page_of_a_seed_word_no_fixed_rule_decides(spark, folder):
    found = queries.op3_url_filters(spark, folder).where("rule IS NULL").collect()
    seeded = [r for r in found if set(re.split("[.-]", r["host"])) & set(queries.SEED_HOST_WORDS)]
    assert seeded and all(r["verdict"] == "block" for r in seeded)


# Language ID


def plain_buckets(text):
    """N-grams of a lower-cased text with a space for every other character, one by one."""
    line = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    found = defaultdict(int)
    for size in language_id.SIZES:
        for at in range(len(line) - size + 1):
            gram = line[at : at + size]
            if " " in gram[1:-1] or not gram.strip():
                continue
            h = 0
            for c in gram:
                h = (h * int(language_id.MULTIPLIERS[0]) + ord(c)) % 2**64
            h = ((h ^ size) * int(language_id.MULTIPLIERS[1])) % 2**64
            found[h >> (64 - language_id.BUCKET_BITS)] += 1
    return dict(found)


def test_ngrams_of_whole_texts_equal_plain_version(monkeypatch):
    texts = ["The cat!", "", "a", "Über-größe 123", "x" * 50, "é😀 b", "many words " * 40]
    for block in (1 << 18, 16):  # sixteen: long texts run over several blocks
        monkeypatch.setattr(language_id, "BLOCK", block)
        for text, (ids, counts) in zip(texts, language_id.counted(texts), strict=True):
            got = dict(zip(np.frombuffer(ids, "<u2").tolist(), np.frombuffer(counts, "<u4").tolist(), strict=True))
            assert got == plain_buckets(text)


@needs_tables
def test_held_out_languages(spark):
    found = queries.op4_language_id(spark, MIDDLE).collect()
    truth = {r["doc_id"]: r["lang"] for r in read(spark, "documents", MIDDLE).collect()}
    held = [r for r in found if r["held_out"]]
    assert len(found) == len(truth) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in found)


def test_languages_of_odd_rows(spark):
    rows = [(1, "the cat and the dog " * 5), (2, "der hund und die katze " * 5), (None, "the dog"), (4, "und der hund"), (5, None), (6, ""), (7, "12 !"), (4, "und der hund"), (8, "the " * 100_000)]
    docs = table(spark, rows, ["en", "de", "en", "de", "de", "de", None, "de", "en"])
    model = language_id.fit(docs)
    found = [(r["doc_id"], r["lang_pred"]) for r in language_id.identify(docs, model).collect()]
    assert found == [(1, "en"), (2, "de"), (None, "en"), (4, "de"), (5, "und"), (6, "und"), (7, "und"), (4, "de"), (8, "en")]
    kept = language_id.accepted(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, None, 4, 8}
    unknown = language_id.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in language_id.identify(docs, unknown).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), model).count() == 0


def test_sample_is_bounded_without_ids_and_with_copies(spark, monkeypatch):
    rows = [(None, f"word{chr(97 + i % 26)} {chr(97 + i // 26 % 26)}{chr(97 + i // 676)} text") for i in range(3000)]
    rows += [(1, "copied words")] * 500 + [(i, f"numbered {chr(97 + i)}") for i in range(5)]
    docs = table(spark, rows, ["en"] * 3000 + ["de"] * 505)
    drawn = []
    monkeypatch.setattr(language_id, "train", lambda sample: drawn.append(sample))
    for parts in (1, 7):
        language_id.fit(docs.repartition(parts), rows_per_language=20)
    samples = [[(lang, ids.tobytes(), counts.tobytes()) for lang, ids, counts in sample] for sample in drawn]
    assert samples[0] == samples[1]
    english, german = ([r for r in samples[0] if r[0] == lang] for lang in ("en", "de"))
    assert len(english) == len(german) == 20 and len(set(german)) == 6


# Decontamination


def plain_overlap(text, item, run=13, share=0.8):
    words = [re.findall(r"[^\W_]+", (t or "").lower()) for t in (text, item)]
    doc, test = words
    if len(test) < 8:  # shorter items match whole only
        return bool(test) and any(doc[i : i + len(test)] == test for i in range(len(doc) - len(test) + 1))
    run = min(run, len(test))
    for shift in range(-len(test), len(doc)):
        same = [0 <= shift + j < len(doc) and doc[shift + j] == test[j] for j in range(len(test))]
        inside = [0 <= shift + j < len(doc) for j in range(len(test))]
        if any(all(inside[i : i + run]) and sum(same[i : i + run]) >= share * run for i in range(len(test) - run + 1)):
            return True
    return False


@pytest.mark.parametrize("most", [500_000, 0])
def test_overlaps_equal_plain_version(spark, most):
    draw = random.Random(5)
    items = [" ".join(draw.choice("abcdefghijklmnop") * draw.randint(1, 3) for _ in range(n)) for n in (20, 40, 8, 7, 13)]
    rows = []
    for number, item in enumerate(items * 6):
        words = item.split()
        part = words if number < 10 else words[: draw.randint(6, len(words))]
        swapped = [w if draw.random() > 0.12 else "other" for w in part]
        rows.append((number, f"Before, it. {' '.join(swapped).title()}! And {draw.random()} after"))
    rows += [(None, "x " + items[0]), (90, None), (91, ""), (92, "short"), (93, items[1] * 2), (93, items[1] * 2), (94, "a " * 5000)]
    tests = spark.createDataFrame(
        [(i, t, "w") for i, t in enumerate(items)] + [(98, None, "w"), (99, "", "w"), (0, items[0], "w")], "item_id long, text string, words string"
    )
    docs = table(spark, rows)
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.overlaps(docs, tests, most_broadcast=most).collect()}
    expected = {(d, i) for d, t in rows for i, item in enumerate(items) if plain_overlap(t, item)}
    assert found <= expected
    # A hit needs one run of eight words whose read positions are untouched; few overlaps lack that.
    assert len(found) >= 0.95 * len(expected) and {d for d, _ in found} >= {0, 1, None, 93} - {3}
    clean = decontamination.decontaminate(docs, tests)
    leaked = {d for d, _ in found}
    assert clean.columns == docs.columns
    assert sorted(map(repr, (r["doc_id"] for r in clean.collect()))) == sorted(repr(d) for d, _ in rows if d not in leaked)
    assert decontamination.overlaps(docs.limit(0), tests).count() == 0
    assert decontamination.decontaminate(docs, tests.limit(0)).count() == len(rows)


def test_every_allowed_substitution_of_short_items_is_found(spark):
    items = {size: [f"w{size}x{i}" for i in range(size)] for size in (8, 9, 10, 11, 13)}
    rows = []
    for size, item in items.items():
        for places in combinations(range(size), 1 if size < 10 else 2):
            changed = ["other" if i in places else w for i, w in enumerate(item)]
            rows.append((len(rows), size, "before " + " ".join(changed) + " after"))
    docs = spark.createDataFrame(rows, "doc_id long, size long, text string")
    tests = spark.createDataFrame([(size, " ".join(item)) for size, item in items.items()], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.overlaps(docs, tests).collect()}
    assert found == {(number, size) for number, size, _ in rows}


def test_items_of_few_words_without_id_and_of_one_id(spark):
    tests = spark.createDataFrame(
        [(1, "Red green blue"), (2, "solo"), (None, "one two three four five six seven eight nine"), (None, "a b c"),
         (3, " ".join(f"p{i}" for i in range(9))), (3, " ".join(f"q{i}" for i in range(9))), (4, "?!"), (5, None)],
        "item_id long, text string",
    )
    docs = table(
        spark,
        [(10, "see red, green blue; red green blue"), (11, "red green"), (12, "solo"), (13, "A b, c"), (14, "soloist"), (15, None),
         (16, "one two three four five six seven eight nine"), (17, " ".join(f"q{i}" for i in range(9)))],
    )
    found = decontamination.overlaps(docs, tests).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(10, 1), (12, 2), (13, None), (16, None), (17, 3)}
    first = next(r for r in found if r["doc_id"] == 10)
    assert (first["doc_word"], first["item_word"], first["n_words"], first["n_equal"]) == (1, 0, 3, 3)
    assert {r["doc_id"] for r in decontamination.decontaminate(docs, tests).collect()} == {11, 14, 15}


# Packing


def check_sequences(rows, window=2048):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    filled = padded = 0
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= window
        filled += at
        padded += window - at if at & (at - 1) else 0
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return padded / filled


@needs_tables
def test_pieces_hold_every_id_once(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    rows = [tuple(r) for r in read(spark, "documents").select("doc_id", "text").limit(100).collect()]
    rows += [(-1, None), (-2, ""), (-3, "<|endoftext|> IT'S Don't. 'LL\x1c…, é. A<|STARTOFTEXT|>. İx ΣΑΣ! ﬁ x" + "z" * 5000)]
    rows += [(-4, "word, " * 30_000)]
    found = packing.pack(table(spark, rows)).collect()
    assert check_sequences(found) < 0.03
    pieces = defaultdict(list)
    for r in found:
        pieces[r["doc_id"]].append((r["start"], r["length"], bytes(r["ids"]), r["doc_tokens"]))
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        parts = sorted(pieces[doc_id])
        assert b"".join(p[2] for p in parts) == struct.pack(f"<{len(ids)}I", *ids)
        assert all(p[3] == len(ids) and len(p[2]) == 4 * p[1] for p in parts)
        assert [p[0] for p in parts] == [sum(q[1] for q in parts[:i]) for i in range(len(parts))]


def test_repeated_rows_rows_without_id_and_nothing(spark):
    found = packing.pack(table(spark, [(1, "a b"), (1, "a b"), (None, "c"), (None, None)])).collect()
    assert sorted((str(r["doc_id"]), r["doc_tokens"]) for r in found) == [("1", 3), ("1", 3), ("None", 1), ("None", 2)]
    check_sequences(found)
    assert packing.pack(table(spark, [])).count() == 0


@pytest.mark.parametrize("shape", ["even", "short", "long", "single"])
def test_plan_uses_each_piece_once_and_pads_little(shape):
    draw = np.random.default_rng(6)
    sizes = {
        "even": draw.integers(1, 1025, 20_000),
        "short": draw.integers(1, 90, 50_000),
        "long": np.concatenate([np.full(5000, 2048), draw.integers(600, 1025, 5000), draw.integers(1, 300, 5000)]),
        "single": np.full(1000, 512),
    }[shape]
    histogram = np.bincount(sizes, minlength=2049)
    used = np.zeros(2049, dtype=int)
    filled = 0
    sequences = packing.plan(histogram)
    for lengths, times in sequences:
        assert times > 0 and sum(lengths) <= 2048
        np.add.at(used, lengths, times)
        filled += times
    assert (used == histogram).all()
    assert filled * 2048 / sizes.sum() < 1.02


def test_solver_reaches_the_least_squares():
    draw = np.random.default_rng(7)
    histogram = np.bincount(draw.integers(1, 1025, 50_000), minlength=2049).astype(float)
    combos = packing.combinations(histogram, 2048)
    assert (combos.sum(axis=1) == 2048).all()
    times = packing.repeat_counts(combos, histogram)
    assert (times >= 0).all()
    used = np.bincount(combos.ravel(), weights=np.repeat(times, combos.shape[1]), minlength=2049)
    used[0] = 0
    assert np.linalg.norm(used - histogram) < 0.1 * np.linalg.norm(histogram)


# Toxicity


def test_folding_and_exception_phrases():
    assert toxicity.fold("St0pid ＬＯＳＥＲ! tr@sh $cum l0ser. 2021") == ["stopid", "loser", "trash", "scum", "loser"]
    model = toxicity.Model({" trash ": 2.0, " lowei": 1.0, " loweibad ": 3.0}, frozenset({"trash can"}), (0, 0, 0))
    machine = model.automaton()
    assert toxicity.matches(machine, toxicity.fold("Trash! a trash can, tra5h"))[0] == {0: 2.0, 18: 2.0}
    assert sorted(toxicity.matches(machine, toxicity.fold("loweibad loweixyz slowei"))[0].values()) == [1.0, 3.0]
    assert toxicity.matches(machine, [])[0] == {}


def test_toxicity_of_planted_words(spark):
    draw = random.Random(8)
    prose = lambda n: [draw.choice("the of and a to in that was he it".split()) + draw.choice(["", "n", "r"]) for _ in range(n)]
    rows, labels = [], []
    for i in range(400):
        words = prose(60)
        bad = i % 4 == 0
        if bad:
            for at in range(0, 60, 20):
                words[at] = draw.choice(["m0ron", "Scum!", "tra$h", "idiot"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad), "x"))
    rows += [(1000, None), (1001, ""), (None, "idiot scum"), (1002, "the " * 50_000), (1003, "moron idiot scum the"), (1003, "moron idiot scum the")]
    marks = spark.createDataFrame([*labels, (None, 1, "x"), (5, None, "x")], "doc_id long, toxic int, text string")
    docs = table(spark, rows)
    train = marks.where("doc_id % 5 <> 0 OR doc_id IS NULL")
    found = toxicity.classify(docs, train).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["doc_id"] is not None and r["doc_id"] < 400 and r["doc_id"] % 5 == 0]
    assert all((r["score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in held)
    odd = {r["doc_id"]: r["score"] for r in found if r["doc_id"] is None or r["doc_id"] >= 1000}
    assert odd[1003] > 0.5 and odd[None] > 0.5 and max(odd[1000], odd[1001], odd[1002]) < 0.5
    assert {r["score"] < 0.5 for r in toxicity.classify(docs, train.limit(0)).collect()} == {True}
    assert toxicity.classify(docs.limit(0), train).count() == 0


def plain_matches(model, words):
    """Words an entry equals or begins, whole phrases struck out, by looking at every word of the text."""
    starts, at = [], 0
    for word in words:
        starts.append(at)
        at += len(word) + 1
    struck = set()
    for phrase in model.exceptions:
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                struck |= set(range(i, i + len(parts)))
    hits = {}
    for i, word in enumerate(words):
        weights = [w for entry, w in model.weights.items() if entry == f" {word} " or entry == f" {word[: len(entry) - 1]}"]
        if weights and i not in struck:
            hits[starts[i]] = max(weights)
    return hits


def test_matches_equal_plain_version():
    draw = random.Random(12)
    vocabulary = ["ab", "abc", "abcde", "abcdef", "abcdefg", "bc", "c", "xabcde"]
    for _ in range(300):
        some = draw.sample(vocabulary, 4)
        weights = {f" {w} " if draw.random() < 0.6 else f" {w}": draw.randint(1, 9) / 2 for w in some}
        phrases = {" ".join(draw.choices(vocabulary, k=2)) for _ in range(3)}
        model = toxicity.Model(weights, frozenset(phrases), (0.0, 0.0, 0.0))
        words = draw.choices(vocabulary, k=draw.randint(0, 12))
        assert toxicity.matches(model.automaton(), words)[0] == plain_matches(model, words)


def test_sample_has_one_text_of_an_id_and_conflicting_labels_are_settled(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(toxicity, "stored", lambda df, purpose: kept.append(df) or df)
    rows = [(7, f"moron {i}") for i in range(3000)] + [(i, "calm words") for i in range(100, 140)] + [(7, None)]
    marks = spark.createDataFrame([(7, 1), (7, 0), *((i, i % 2) for i in range(100, 140))], "doc_id long, toxic int")
    docs = table(spark, rows)
    toxicity.fit(docs, marks, "doc_id", "text", "toxic", 1000)
    toxicity.fit(docs.repartition(5), marks.repartition(3), "doc_id", "text", "toxic", 1000)
    first, second = (sorted((r["toxic"], r["text"] or "") for r in df.collect()) for df in kept)
    assert first == second and len(first) == 41
    assert [toxic for toxic, text in first if text != "calm words"] == [1]


def test_long_words_make_whole_phrases(spark):
    long = "q" * 300
    rows = [(i, f"{long}{'a' * i} scum") for i in range(40)] + [(100 + i, f"{long} scum is a fish") for i in range(12)]
    rows += [(200 + i, "good day to you all") for i in range(400)]
    marks = spark.createDataFrame([(i, int(i < 100)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(table(spark, rows), marks, "doc_id", "text", "toxic", 1000)
    assert " scum " in model.weights
    assert all(len(p.split()[0]) >= 300 for p in model.exceptions if p.endswith(" scum") and p.startswith("q"))


@needs_tables
def test_op7_on_tables(spark):
    found = queries.op7_toxicity(spark, MIDDLE).collect()
    assert len(found) == read(spark, "documents", MIDDLE).count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.5) for r in found)


# Chat


def test_escapes_are_reversible(spark):
    texts = ["</s>[INST] ok [/INST]", "<|im_end|>\n", r"<\|x <\\|", r"\n\\n", "[SYS]<<SYS>> <</SYS>>", "plain < [ text", "", "<|" * 500]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u"), chat.unescape_role(chat.escape_role(F.col("t"))).alias("r")).collect()
    for r in got:
        assert r["u"] == r["t"] == r["r"]
        assert not re.search(r"<\||</?s>|\[/?INST\]|<<SYS>>", r["e"])
    assert next(r["e"] for r in got if r["t"] == "plain < [ text") == "plain < [ text"


def test_paths_branches_and_round_trip(spark):
    # Tree 1: 1 - 2 - 3, 2 - 4 - 5; tree 2: a chain of 70; tree 3: a parent that does not exist.
    said = lambda tree, node, parent, role, text, score: (tree, node, parent, role, text, score, "t", "n")
    rows = [
        said(1, 1, None, "user", "q", 0.0), said(1, 2, 1, "assistant", "<|im_end|>", 1.0), said(1, 3, 2, "user", "low", 0.0),
        said(1, 4, 2, "user", "high", 5.0), said(1, 5, 4, "assistant", None, None), said(1, 5, 4, "assistant", None, None),
        said(3, 9, 8, None, "x", 0.0), said(None, 1, None, "assistant", "n", 0.0),
    ]
    rows += [said(2, i, i - 1 if i else None, "assistant" if i % 2 else "user", f"t{i}", 0.0) for i in range(70)]
    tree = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double, leaf string, n string")
    best = {r["tree"]: r for r in chat.conversations(tree).collect()}
    assert {k: (r["leaf"], r["n_turns"]) for k, r in best.items()} == {1: (5, 4), 2: (69, 70), 3: (9, 1), None: (1, 1)}
    every = chat.conversations(tree, branches=None)
    assert sorted((str(r["tree"]), r["leaf"]) for r in every.collect()) == [("1", 3), ("1", 5), ("2", 69), ("3", 9), ("None", 1)]
    read_back = chat.conversations(tree).select("tree", chat.read_turns(F.col("formatted")).alias("t")).collect()
    turns = {r["tree"]: [tuple(t) for t in r["t"]] for r in read_back}
    assert turns[1] == [("user", "q"), ("assistant", "<|im_end|>"), ("user", "high"), ("assistant", "")]
    assert turns[2] == [("assistant" if i % 2 else "user", f"t{i}") for i in range(70)] and turns[3] == [("", "x")]
    covered = best[2]["formatted"]
    assert [covered[s["start"] : s["start"] + s["length"]] for s in best[2]["loss_spans"]] == [f"t{i}" for i in range(1, 70, 2)]
    assert chat.conversations(tree.limit(0)).count() == 0


def test_repeated_messages_take_one_whole_row(spark):
    # The row with the least parent counts, for the path and for what is said, in whatever order the rows stand.
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "user", "a", 2.0), (1, 3, 2, "user", "late", 9.0), (1, 3, 1, "user", "z", 1.0), (1, 3, 1, "user", "y", 4.0)]
    for said in (rows, rows[::-1]):
        tree = spark.createDataFrame(said, "tree long, node long, parent long, role string, text string, score double")
        every = chat.conversations(tree, branches=None).select("leaf", "score", chat.read_turns(F.col("formatted")).alias("t"))
        found = {r["leaf"]: (r["score"], [t[1] for t in r["t"]]) for r in every.collect()}
        assert found == {2: (1.0, ["q", "a"]), 3: (2.0, ["q", "y"])}


def test_chain_orders_ties_and_nulls(spark):
    rows = [(1, 1, "b", "y", 0), (1, 1, "b", "x", 0), (1, 0, None, None, 0), (1, None, "a", "first", 0), (1, 1, "b", "x", 0), (None, 0, "assistant", "a", 0)]
    talk = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tree int")
    found = {r["conv_id"]: r for r in chat.readback(chat.conversations(chat.chain(talk))).collect()}
    expected = "a\nfirst\n\n\nb\nx\nb\nx\nb\ny\n"
    assert found[1]["turns_sha256"] == hashlib.sha256(expected.encode()).hexdigest() and found[1]["n_turns"] == 5
    assert found[None]["loss_chars"] == 1


@needs_tables
def test_op9_equals_its_sql(spark):
    oracle = duckdb.connect()
    oracle.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL}/conversations.parquet'")
    result = oracle.execute(queries.ORACLE["op9_chat_formatting"])
    names = [d[0] for d in result.description]
    found = queries.op9_chat_formatting(spark, SMALL).select(*names).collect()
    assert sorted(map(tuple, found)) == sorted(result.fetchall())


# Personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_accepts(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        twice = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def plain_spans(text):
    return ",".join(
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in PLAIN.items()
        for m in re.finditer(pattern, text or "")
        if plain_accepts(kind, m.group())
    )


def odd_texts():
    draw = random.Random(9)
    texts = ["a@b.c_d@e.f", "x" * 50_000 + "@" + "y" * 10, "1" * 50_000, "1-" * 30_000 + "1", "1.2.3.4.5.6.7.8", "a@b.c@d.e", "%+-@a-.b-"]
    texts += ["é😀 a.b@c.de, 256.1.1.1 1.1.1.256 001.002.003.004", "+1 (2) 3.4-567 8901 ..", "4012888888881881 4012 8888-8888 1881", "", None]
    return texts + ["".join(draw.choice("1234 .-+@a()é") for _ in range(60)) for _ in range(300)]


def test_base_spans_equal_plain_version(spark):
    rows = list(enumerate(odd_texts())) + [(None, "x@y.z"), (5, "x@y.z")]
    found = pii.find(table(spark, rows)).select("doc_id", pii.written(F.col("base")).alias("s")).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(repr((i, plain_spans(t))) for i, t in rows)
    assert pii.find(table(spark, [])).count() == 0


def test_patterns_around_seeds_discover_identifiers(spark):
    rows = [(i, f"Please call me at +1 (555) 010-{1000 + i} or later") for i in range(40)]
    rows += [(100 + i, f"please call me at 555-010-{7000 + i} or later") for i in range(4)] + [(200, "see chapter 555-010-9999 of 12345678")]
    found = {r["doc_id"]: r for r in pii.find(table(spark, rows)).collect()}
    assert all(len(found[i]["base"]) == 1 and not found[i]["more"] for i in range(40))
    assert all([tuple(s) for s in found[100 + i]["more"]] == [(3, 18, 30)] for i in range(4))
    assert not found[200]["more"]
    cleaned = {r["doc_id"]: r["text"] for r in pii.redact(table(spark, rows)).collect()}
    assert cleaned[3] == "Please call me at <PHONE> or later" and cleaned[101] == "please call me at <PHONE> or later"
    assert cleaned[200] == rows[-1][1]


def test_redaction_replaces_spans_and_keeps_the_rest(spark):
    rows = list(enumerate(odd_texts()))
    docs = table(spark, rows)
    cleaned = pii.redact(docs)
    assert cleaned.columns == docs.columns
    for r in cleaned.collect():
        text = rows[r["doc_id"]][1]
        if not plain_spans(text):
            assert r["text"] == text
            continue
        spans = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in plain_spans(text).split(",")))
        out, at = "", 0
        for a, b, kind in sorted(spans, key=lambda s: (s[0], s[1], pii.KINDS.index(s[2]))):
            if a < at:
                at = max(at, b)
                continue
            out, at = out + text[at:a] + f"<{kind.upper()}>", b
        assert r["text"] == out + text[at:]


@needs_tables
def test_op10_on_tables(spark):
    texts = {r["doc_id"]: r["text"] for r in read(spark, "documents").collect()}
    for r in queries.op10_pii(spark, SMALL).collect():
        expected = plain_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(expected.encode()).hexdigest()
        assert set(expected.split(",")) <= set(r["spans"].split(","))
        assert r["n_email"] == expected.count("email:") and r["n_phone"] == expected.count("phone:")


# Pipeline


@needs_tables
def test_pipeline_stages_take_effect(spark):
    from stratalake.llm.common import stored

    docs = read(spark, "documents")
    given, kept = docs.count(), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL), f"test-{name}")
        kept[name] = docs
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash_near_dedup", "decontamination", "pii", "packing"]
    assert all(kept[n].columns == read(spark, "documents").columns for n in names[:-1])
    counts = {n: kept[n].count() for n in names}
    assert given >= counts["language_id"] > 0.99 * given
    ids = lambda n: {r["doc_id"] for r in kept[n].select("doc_id").collect()}
    labels = queries.op2_simhash_near_dedup(spark, SMALL).collect()
    assert ids("simhash_near_dedup") == {r["component_id"] for r in labels if r["doc_id"] in ids("language_id")}
    leaked = {r["doc_id"] for r in queries.op5_decontamination(spark, SMALL).collect()}
    assert ids("decontamination") == ids("simhash_near_dedup") - leaked and leaked & ids("simhash_near_dedup")
    assert ids("pii") == ids("decontamination")
    before = {r["doc_id"]: r["text"] for r in kept["decontamination"].collect()}
    for r in kept["pii"].collect():
        assert plain_spans(r["text"]) == "" and r["n_chars"] == len(r["text"])
        assert plain_spans(before[r["doc_id"]]) or r["text"] == before[r["doc_id"]]
    pieces = kept["packing"].collect()
    check_sequences(pieces)
    assert {r["doc_id"] for r in pieces} == ids("pii")


def test_pipeline_of_nothing_and_odd_rows(spark, tmp_path):
    rows = [(1, "the cat sat on the mat with the hat"), (1, "the cat sat on the mat with the hat"), (2, None), (None, "the dog and the cat"), (3, ""), (4, "12 34"), (5, "call +1 (555) 010-9999 the cat")]
    tests = spark.createDataFrame([(1, None)], "item_id long, text string")
    for name, docs in (("odd", table(spark, rows, ["en"] * len(rows))), ("none", table(spark, []))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        tests.write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    found = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["1", "5", "None"]
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_ids_of_words_equal_the_tokenizer():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.TOKENIZER)
    known = packing.word_ids(packing.TOKENIZER)
    assert known.parts
    rng = random.Random(11)
    signs = "abzAZéÉßİſ0189²½ª_-.,;:!?'\"<>|#$%&*()@/\\^~`{}[]=+€ñÑœĳŉ̀日ٱﬁΩςı\x00\x1f\x85\xa0\xad"
    texts = ["".join(rng.choices(signs, k=rng.randint(1, 9))) for _ in range(8000)]
    texts += ["don't", "WE'LL.", "<|endoftext|>", "x<|startoftext|>y", "İstanbul", "ab###", "A1.B2,", "…a", "a" * 300]
    for text in texts:
        for word in text.encode().split():
            ids = whole.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
            assert known[word] == struct.pack(f"<{len(ids)}I", *ids), word


def test_long_texts_cost_in_proportion(spark):
    def seconds(tokens):
        text = " ".join(f"id{i:06d} 10.0.{i % 200}.{i % 7}" for i in range(tokens))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        begin = time.perf_counter()
        (found,) = pii.find(docs).collect()
        spent = time.perf_counter() - begin
        spans = [text[s["start"] : s["end"]] for s in found["base"]]
        assert spans == [word for word in text.split() if word.startswith("10.")]
        return spent

    seconds(50)
    assert seconds(20_000) < 3 * seconds(5_000)


def test_redaction_across_chunks(spark):
    size = pii.CHUNK
    texts = ["x" * (size - 3) + " a@b.cc " + "y" * size + " 10.0.0.1", "a@b.cc" + " 1.2.3.4" * size, "z" * (3 * size), ""]
    rows = pii.redact(table(spark, list(enumerate(texts)))).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == {
        0: "x" * (size - 3) + " <EMAIL> " + "y" * size + " <IP>",
        1: "<EMAIL>" + " <IP>" * size,
        2: "z" * (3 * size),
        3: "",
    }
