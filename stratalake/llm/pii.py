"""Personal data: fixed patterns per kind, and identifiers found by bootstrapped contextual extraction.

Only DataFrame functions. Spans of the fixed patterns are the seeds. The words around seeds become lexical patterns;
patterns and the identifier-shaped tokens they surround form a graph on which Spark scores both sides in rounds, and
confident patterns give spans that no fixed pattern matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

KINDS = ("email", "ip", "card", "phone")
# The kinds' patterns. Possessive repeats and the look-behinds change no match: they keep a long run of letters or
# digits from being tried again from each of its characters, and keep Java from recursing per repetition.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What a text must contain for a pattern to match at all.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
IP_PARTS = r"^(0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(\.|$)){4}$"
# A token that may be an identifier: at least six characters without white space, a digit among them.
TOKEN = r"(?<!\S)(?=\S*?[0-9])\S{6,}+"
# Confidence a pattern or an instance needs, seeds a pattern needs, and rounds of scoring.
MIN_CONFIDENCE = 0.8
MIN_SUPPORT = 5
ROUNDS = 3
SPAN = "struct<kind:int,start:int,end:int>"
# Words around a span are sought within this many code points. Long texts are worked on in chunks of code points, long
# arrays in blocks of elements.
REACH = 60
CHUNK = 1024
BLOCK = 64


def accepted(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(IP_PARTS)
    if kind == "card":
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def located(text: Column, pattern: str) -> Column:
    """All matches from the left, not overlapping, as an array of ``(match, start, end)`` in code points.

    What lies between matches is taken by splitting at the same pattern, so positions are sums of lengths. They are
    summed within blocks of matches, then over blocks, since appending to one long array copies it every time.
    """
    pieces = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"), F.split(text, pattern, -1).alias("gap"))
    nothing = F.array().cast("array<struct<match:string,start:int,end:int>>")

    def step(acc: Column, piece: Column) -> Column:
        begin = acc["at"] + F.length(piece["gap"])
        end = begin + F.length(piece["match"])
        here = F.struct(piece["match"].alias("match"), begin.alias("start"), end.alias("end"))
        return F.when(piece["match"].isNull(), acc).otherwise(
            F.struct(end.alias("at"), F.array_append(acc["found"], here).alias("found"))
        )

    def block(every: Column, first: Column) -> Column:
        return F.aggregate(F.slice(every, first + 1, BLOCK), F.struct(F.lit(0).alias("at"), nothing.alias("found")), step)

    def shifted(found: Column, by: Column) -> Column:
        return F.transform(
            found,
            lambda m: F.struct(m["match"].alias("match"), (m["start"] + by).alias("start"), (m["end"] + by).alias("end")),
        )

    def of(every: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.size(every) - 1, F.lit(BLOCK)), lambda first: block(every, first))
        return let(
            blocks,
            lambda parts: F.flatten(
                F.zip_with(
                    parts,
                    F.aggregate(
                        parts,
                        F.array(F.lit(0)),
                        lambda sums, part: F.array_append(sums, F.element_at(sums, -1) + part["at"]),
                    ),
                    lambda part, by: F.coalesce(shifted(part["found"], by), nothing),
                )
            ),
        )

    return let(pieces, of)


def chunked(text: Column) -> Column:
    """The text in pieces of ``CHUNK`` code points, each with its first position."""
    return F.transform(
        F.sequence(F.lit(0), F.length(text), F.lit(CHUNK)),
        lambda a: F.struct(a.alias("at"), F.substring(text, a + 1, F.lit(CHUNK)).alias("text")),
    )


def spans_of(kind: str, text: Column) -> Column:
    """Accepted spans of one kind as an array of ``(kind, start, end)``, ``kind`` numbered as in ``KINDS``."""
    found = F.filter(located(text, PATTERNS[kind]), lambda m: accepted(kind, m["match"]))
    spans = F.transform(found, lambda m: F.struct(F.lit(KINDS.index(kind)).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
    if kind in NEEDS:
        possible = F.contains(text, F.lit(NEEDS[kind]))
    else:
        possible = text.rlike("[0-9](?:[ -]?[0-9]){12}")
    return F.when(possible, spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(text: Column) -> Column:
    """Spans of all fixed patterns, by kind as in ``KINDS``, then start."""
    return F.concat(*[spans_of(kind, text) for kind in KINDS])


def near(chunks: Column, start: Column, size: Column) -> Column:
    """``size`` code points from ``start`` on, at most ``CHUNK`` of them; only two chunks are read for it."""
    at = F.floor(start / CHUNK).cast("int")
    both = F.concat(F.get(chunks, at)["text"], F.coalesce(F.get(chunks, at + 1)["text"], F.lit("")))
    return F.substring(both, start - at * CHUNK + 1, size)


def contexts(text: Column, spans: Column) -> Column:
    """For ``(kind, start, end)`` spans: the span's text and its lexical patterns, lower-cased.

    A pattern is the two words before, or the word before and the word after. Where such words are missing, so is the
    pattern. Words that do not end within ``REACH`` code points make none, rather than one of a fragment.
    """

    def patterns_of(words: Column) -> Column:
        two, one, behind = words["two"], words["one"], words["behind"]
        return F.array_compact(
            F.array(
                F.when(two != "", F.concat(F.regexp_replace(two, r"\s+", " "), F.lit(" _"))),
                F.when((one != "") & (behind != ""), F.concat(one, F.lit(" _ "), behind)),
            )
        )

    def around(chunks: Column, length: Column, s: Column) -> Column:
        first = F.greatest(s["start"] - REACH, F.lit(0))
        # The ends of the text count as white space.
        edge = F.when(first == 0, " ").otherwise("")
        before = F.lower(F.concat(edge, near(chunks, first, s["start"] - first)))
        last = F.when(length <= s["end"] + REACH, " ").otherwise("")
        after = F.lower(F.concat(near(chunks, s["end"], F.lit(REACH)), last))
        words = let(
            before,
            lambda words: F.struct(
                F.regexp_extract(words, r"\s(\S+\s+\S+)\s*+$", 1).alias("two"),
                F.regexp_extract(words, r"\s(\S+)\s*+$", 1).alias("one"),
                F.regexp_extract(after, r"^\s*(\S+)\s", 1).alias("behind"),
            ),
        )
        size = s["end"] - s["start"]
        token = F.when(size <= CHUNK, near(chunks, s["start"], size)).otherwise(F.substring(text, s["start"] + 1, size))
        return F.struct(
            s["kind"].alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lower(token).alias("token"),
            let(words, patterns_of).alias("patterns"),
        )

    return F.when(
        F.size(spans) > 0,
        let(
            chunked(text),
            lambda chunks: let(
                F.length(text), lambda length: F.transform(spans, lambda s: around(chunks, length, s))
            ),
        ),
    ).otherwise(F.array().cast("array<struct<kind:int,start:int,end:int,token:string,patterns:array<string>>>"))


def apart(tokens: Column, base: Column) -> Column:
    """The tokens that touch no base span. Each is held against the base spans near it, found once for each stretch of
    ``BLOCK`` tokens."""

    def touch(t: Column, b: Column) -> Column:
        return (b["start"] < t["end"]) & (t["start"] < b["end"])

    def block(every: Column, bases: Column, first: Column) -> Column:
        def free(stretch: Column) -> Column:
            whole = F.struct(stretch[0]["start"].alias("start"), F.element_at(stretch, -1)["end"].alias("end"))
            close = F.filter(bases, lambda b: touch(whole, b))
            return let(close, lambda some: F.filter(stretch, lambda t: ~F.exists(some, lambda b: touch(t, b))))

        return let(F.slice(every, first + 1, BLOCK), free)

    def of(every: Column, bases: Column) -> Column:
        firsts = F.sequence(F.lit(0), F.size(every) - 1, F.lit(BLOCK))
        kept = F.flatten(F.transform(firsts, lambda first: block(every, bases, first)))
        return F.when((F.size(every) > 0) & (F.size(bases) > 0), kept).otherwise(every)

    return let(tokens, lambda every: let(base, lambda bases: of(every, bases)))


def bootstrapped(met: DataFrame, rounds: int, confidence: float, support: int) -> DataFrame:
    """``(token, kind)`` of the identifiers that confident patterns discover.

    ``met`` holds ``(kind, token, pattern)``, ``kind`` null where no fixed pattern matches. A pattern's confidence in
    a kind is the mean confidence of the distinct tokens it surrounds; it must rest on ``support`` tokens' worth. A
    token's confidence is one minus the product of its confident patterns' doubts. Seeds keep confidence one.
    """
    edges = stored(met.select("pattern", "token").distinct(), "pii-graph")
    sizes = stored(edges.groupBy("pattern").agg(F.count("*").alias("tokens")), "pii-patterns")
    seeds = stored(met.where("kind IS NOT NULL").groupBy("token").agg(F.min("kind").alias("kind")), "pii-seeds")
    believed = seeds.select("token", "kind", F.lit(1.0).alias("belief"))
    found = None
    for _ in range(rounds):
        scored = edges.join(believed, "token").groupBy("pattern", "kind").agg(F.sum("belief").alias("mass"))
        confident = (
            scored.join(sizes, "pattern")
            .where((F.col("mass") >= support) & (F.col("mass") / F.col("tokens") >= confidence))
            .select("pattern", "kind", (F.col("mass") / F.col("tokens")).alias("score"))
        )
        doubt = F.least(F.lit(1.0) - F.col("score"), F.lit(1.0))
        tokens = (
            edges.join(confident, "pattern")
            .groupBy("token", "kind")
            .agg((F.lit(1.0) - F.exp(F.sum(F.log(F.greatest(doubt, F.lit(1e-9)))))).alias("belief"))
            .where(F.col("belief") >= confidence)
        )
        best = tokens.groupBy("token").agg(F.max(F.struct("belief", -F.col("kind"))).alias("best"))
        found = stored(
            best.join(seeds.select("token"), "token", "left_anti").select(
                "token", (-F.col("best.col2")).alias("kind"), F.col("best.belief").alias("belief")
            ),
            "pii-found",
        )
        believed = seeds.select("token", "kind", F.lit(1.0).alias("belief")).unionByName(found)
    return found.select("token", "kind")


def find(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = ROUNDS,
    confidence: float = MIN_CONFIDENCE,
    support: int = MIN_SUPPORT,
) -> DataFrame:
    """Per row ``(doc_id, text_hash, base, more)``: arrays of ``(kind, start, end)``, kinds numbered as in ``KINDS``.

    ``base`` holds the fixed patterns' spans, ``more`` the discovered ones, both by kind, then start, in code points.
    Null text is empty; rows without an id or repeated rows are each returned. An empty table gives no rows; other
    columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("text_hash"), base_spans(F.col("text")).alias("base"))
    tokens = F.transform(
        located(F.col("text"), TOKEN),
        lambda m: F.struct(F.lit(None).cast("int").alias("kind"), m["start"].alias("start"), m["end"].alias("end")),
    )
    fresh = apart(tokens, F.col("base"))
    fresh = F.when(F.col("text").rlike("[0-9]"), fresh).otherwise(F.array().cast(f"array<{SPAN}>"))
    marked = stored(
        rows.withColumn("fresh", fresh).select(
            "doc_id", "text_hash", "base", contexts(F.col("text"), F.concat("base", "fresh")).alias("met")
        ),
        "pii-spans",
    )
    places = marked.select("doc_id", "text_hash", F.inline("met"))
    graph = places.select("kind", "token", F.explode("patterns").alias("pattern"))
    found = bootstrapped(graph, rounds, confidence, support)
    more = (
        places.where("kind IS NULL")
        .drop("kind")
        .join(found, "token")
        .groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"))
        .agg(F.sort_array(F.collect_set(F.struct("kind", "start", "end"))).alias("more"))
    )
    same = (F.col("text_hash") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("d"))
    return marked.join(more, same, "left").select(
        "doc_id", "text_hash", "base", F.coalesce("more", F.array().cast(f"array<{SPAN}>")).alias("more")
    )


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; overlapping spans give one, the first's kind.

    Rows, ids and other columns stay; null texts stay null.
    """
    found = find(docs, id_col, text_col, **settings)
    more = found.where(F.size("more") > 0).select(
        F.col("doc_id").alias("pii_id"), F.col("text_hash").alias("pii_hash"), F.col("more").alias("pii_more")
    ).distinct()
    text = F.coalesce(docs[text_col], F.lit(""))
    same = (F.xxhash64(text) == more["pii_hash"]) & docs[id_col].cast("long").eqNullSafe(more["pii_id"])
    joined = docs.join(more, same, "left")
    spans = F.concat(base_spans(text), F.coalesce(more["pii_more"], F.array().cast(f"array<{SPAN}>")))
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def step(chunk: Column, acc: Column, s: Column) -> Column:
        gap = F.substring(chunk["text"], acc["at"] - chunk["at"] + 1, s["start"] - acc["at"])
        return F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))).otherwise(
            F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.element_at(names, s["kind"] + 1)).alias("out"))
        )

    def rewritten(every: Column, chunk: Column) -> Column:
        """A chunk with its spans replaced; a span's name stands where it starts."""
        end = chunk["at"] + CHUNK
        earlier = F.array_max(F.transform(F.filter(every, lambda s: s["start"] < chunk["at"]), lambda s: s["end"]))
        begin = F.struct(F.greatest(F.coalesce(earlier, chunk["at"]), chunk["at"]).alias("at"), F.lit("").alias("out"))
        inside = F.filter(every, lambda s: (s["start"] >= chunk["at"]) & (s["start"] < end))

        def rest(acc: Column) -> Column:
            left = F.substring(chunk["text"], acc["at"] - chunk["at"] + 1, F.greatest(end - acc["at"], F.lit(0)))
            return F.concat(acc["out"], left)

        return F.aggregate(inside, begin, lambda acc, s: step(chunk, acc, s), rest)

    cleaned = let(ordered, lambda every: F.array_join(F.transform(chunked(text), lambda chunk: rewritten(every, chunk)), ""))
    changed = F.when(docs[text_col].isNull() | (F.size(spans) == 0), docs[text_col]).otherwise(cleaned)
    return joined.select(*[changed.alias(c) if c == text_col else docs[c] for c in docs.columns])
