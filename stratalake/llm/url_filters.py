"""URL filters: fixed host and path rules, then association rules mined from labelled URLs.

Only DataFrame functions and Spark's own FP-growth. A URL becomes a set of tokens, labelled URLs are the transactions,
and rules from token combinations to a label are kept by confidence and support. Rules of one token are counted over
all labelled URLs; combinations are mined from a bounded sample, without the tokens that already decide alone, so
neither the driver's share nor the number of combinations grows with the input. Each rule is filed under its rarest
token; a URL looks up its tokens in that index and the rules found are checked in full.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

ALLOW, BLOCK = "allow", "block"
# A mined rule holds for at least this many labelled URLs, whatever their number: a share would rise with the input and
# hide rare hosts. Confidence does the pruning; a least share of all labelled URLs can be asked for besides.
MIN_SUPPORT = 0.0
MIN_ROWS = 2
MIN_CONFIDENCE = 0.9
# A combination of tokens, or one token that is no part of a host, holds for at least this many labelled URLs.
MIN_ROWS_TOGETHER = 10
# Labelled URLs of each verdict, in expectation, that combinations are mined from, and tokens of each that are combined.
MOST_URLS = 20_000
MOST_TOKENS = 12
LABEL = "label:"
# Mined rules sent to every task; above this many they are joined by a shuffle.
MOST_BROADCAST_RULES = 100_000

LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without a ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest ``(verdict, host, path)`` rule that fits, else nulls.

    A rule fits its host and all subdomains if the path starts with the rule's. Meant for short lists of rules.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return name, verdict


def tokens(url: Column) -> Column:
    """Scheme, host parts, path parts, query names and fragment of a URL as a set; digits count as ``#``."""
    whole = F.coalesce(url, F.lit(""))

    def marked(kind: str, found: Column) -> Column:
        return F.transform(
            F.filter(found, lambda t: t != ""), lambda t: F.concat(F.lit(kind), F.regexp_replace(t, "[0-9]+", "#"))
        )

    parts = [
        marked("scheme:", F.array(F.lower(F.regexp_extract(whole, r"(?s)^(.*?)://", 1)))),
        marked("host:", F.split(host(whole), r"[.-]+", -1)),
        marked("path:", F.split(path(whole), r"[/._-]+", -1)),
        marked("query:", F.regexp_extract_all(whole, F.lit(r"[?&]([^=&#?]+)"), F.lit(1))),
        marked("fragment:", F.array(F.regexp_extract(whole, r"(?s)#(.*)$", 1))),
    ]
    return F.array_distinct(F.concat(*parts))


def mined_rules(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_rows: int = MIN_ROWS,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """``(tokens, verdict, confidence, support, rarest)`` mined from all rows ``(tokens, verdict)``.

    ``rarest`` is the rule's token that fewest labelled URLs have, ties by name. No labelled rows, no rules.
    """
    rows = labelled.where("verdict IS NOT NULL")
    total = rows.count()
    if not total:
        return labelled.sparkSession.createDataFrame(
            [], "tokens array<string>, verdict string, confidence double, support double, rarest string"
        )
    # FP-growth rounds the share's rows up; half a row less makes that min_rows exactly.
    share = min(max(min_support, (min_rows - 0.5) / total), 1.0)
    transactions = rows.select(F.array_append("tokens", F.concat(F.lit(LABEL), "verdict")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=min_confidence).fit(transactions)
    found = model.associationRules.where(F.element_at("consequent", 1).startswith(LABEL))
    rules = found.select(
        F.array_sort("antecedent").alias("tokens"),
        F.substring(F.element_at("consequent", 1), len(LABEL) + 1, 1 << 20).alias("verdict"),
        "confidence",
        "support",
    ).where(~F.exists("tokens", lambda t: t.startswith(LABEL)))
    rules = stored(rules, "url-rules")
    single = model.freqItemsets.where(F.size("items") == 1).select(F.element_at("items", 1).alias("token"), "freq")
    rarest = (
        rules.select("tokens", "verdict", F.explode("tokens").alias("token"))
        .join(single, "token")
        .groupBy("tokens", "verdict")
        .agg(F.min(F.struct("freq", "token")).alias("least"))
        .select("tokens", "verdict", F.col("least.token").alias("rarest"))
    )
    return rules.join(rarest, ["tokens", "verdict"])


def single_rules(rows: DataFrame, min_rows: int, min_rows_together: int, min_confidence: float) -> DataFrame:
    """Rules of one token, as ``mined_rules`` gives them, counted over all rows ``(url, tokens, verdict)``."""
    total = rows.count()
    by_verdict = rows.select("verdict", F.explode("tokens").alias("token")).groupBy("token", "verdict").agg(F.count("*").alias("hits"))
    said = by_verdict.groupBy("token").agg(F.sum("hits").alias("n"), F.collect_list(F.struct("verdict", "hits")).alias("said"))
    enough = F.when(F.col("token").startswith("host:"), F.lit(min_rows)).otherwise(F.lit(min_rows_together))
    return (
        said.select("token", "n", F.inline("said"))
        .where((F.col("hits") >= enough) & (F.col("hits") >= min_confidence * F.col("n")))
        .select(
            F.array("token").alias("tokens"),
            "verdict",
            (F.col("hits") / F.col("n")).alias("confidence"),
            (F.col("hits") / F.lit(max(total, 1))).alias("support"),
            F.col("token").alias("rarest"),
        )
    )


def combinable(rows: DataFrame, alone: DataFrame, default: str, min_rows: int, most_urls: int, most_tokens: int) -> DataFrame:
    """``(tokens, verdict)`` of a sample of ``rows``, with only the tokens worth combining.

    About ``most_urls`` URLs of each verdict are drawn by the hash of the URL. Left out are tokens that decide ``alone``,
    those too rare among URLs of other verdicts than ``default`` to be in any rule, and all but one of tokens that
    stand on the very same URLs. Of the rest each URL keeps the ``most_tokens`` likeliest beside those verdicts.
    """
    counts = {r["verdict"]: r["n"] for r in rows.groupBy("verdict").agg(F.count("*").alias("n")).collect()}
    share = F.lit(1.0)
    for verdict, n in counts.items():
        share = F.when(F.col("verdict") == verdict, F.lit(min(1.0, most_urls / n))).otherwise(share)
    drawn = rows.where(F.pmod(F.xxhash64("url"), F.lit(1_000_000)) / 1_000_000 < share)
    placed = drawn.select("url", "verdict", F.explode("tokens").alias("token")).join(
        alone.select(F.col("rarest").alias("token")), "token", "left_anti"
    )
    other = F.sum((F.col("verdict") != default).cast("long"))
    known = placed.groupBy("token").agg(
        F.count("*").alias("n"), other.alias("hits"), F.bit_xor(F.xxhash64("url", "verdict")).alias("places")
    )
    worth = known.where(F.col("hits") >= min_rows).groupBy("n", "hits", "places").agg(F.min("token").alias("token"))
    worth = stored(worth.select("token", (-F.col("hits") / F.col("n")).alias("first"), "n"), "url-tokens")
    kept = placed.join(worth, "token").groupBy("url", "verdict").agg(
        F.array_sort(F.collect_list(F.struct("first", "n", "token"))).alias("ranked")
    )
    return kept.select(F.slice(F.col("ranked.token"), 1, most_tokens).alias("tokens"), "verdict")


def telling_rules(
    labelled: DataFrame,
    default: str = ALLOW,
    min_rows: int = MIN_ROWS,
    min_rows_together: int = MIN_ROWS_TOGETHER,
    min_confidence: float = MIN_CONFIDENCE,
    most_urls: int = MOST_URLS,
    most_tokens: int = MOST_TOKENS,
) -> DataFrame:
    """Rules for other verdicts than ``default`` from rows ``(url, tokens, verdict)``, each distinct URL counted once.

    A host's part needs ``min_rows`` URLs, any other token and any combination ``min_rows_together``. A combination
    goes if a part of it predicts the same verdict as surely. Columns as in ``mined_rules``.
    """
    rows = stored(labelled.where("verdict IS NOT NULL").dropDuplicates(["url", "verdict"]), "labelled-urls")
    alone = stored(single_rules(rows, min_rows, min_rows_together, min_confidence).where(F.col("verdict") != default), "url-rules")
    mixed = stored(combinable(rows, alone, default, min_rows_together, most_urls, most_tokens), "url-sample")
    mined = mined_rules(mixed, min_rows=min_rows_together, min_confidence=min_confidence)
    together = stored(mined.where((F.col("verdict") != default) & (F.size("tokens") > 1)), "url-rules")
    columns = ["tokens", "verdict", "confidence", "support", "rarest"]
    every = mined.where((F.col("verdict") != default) & (F.size("tokens") == 1)).select(columns).unionByName(together.select(columns))
    parts = every.select(F.col("tokens").alias("part"), "verdict", F.col("confidence").alias("sure"), F.col("rarest").alias("token"))
    covered = (
        together.select("tokens", "verdict", "confidence", F.explode("tokens").alias("token"))
        .join(parts, ["token", "verdict"])
        .where((F.size("part") < F.size("tokens")) & (F.col("sure") >= F.col("confidence")))
        .where(F.size(F.array_except("part", "tokens")) == 0)
        .select("tokens", "verdict")
        .distinct()
    )
    return alone.select(columns).unionByName(every.join(covered, ["tokens", "verdict"], "left_anti").select(columns))


def predicted(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``(row, mined)`` for rows ``(row, tokens)`` some rule fits: the verdict of the most confident rule, ties by
    support, then number of tokens, then name."""
    index = rules.select(
        F.col("tokens").alias("needed"), "verdict", "confidence", "support", F.col("rarest").alias("token")
    )
    if rules.limit(MOST_BROADCAST_RULES + 1).count() <= MOST_BROADCAST_RULES:
        index = F.broadcast(index)
    looked_up = pages.select("row", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    fitting = looked_up.where(F.size(F.array_except("needed", "tokens")) == 0)
    best = F.max(F.struct("confidence", "support", F.size("needed").alias("size"), "verdict"))
    return fitting.groupBy("row").agg(best.alias("best")).select("row", F.col("best.verdict").alias("mined"))


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules: list[tuple[str, str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    label_id_col: str = "doc_id",
    default: str = ALLOW,
    **settings,
) -> DataFrame:
    """Per row ``(page_id, url, host, path, rule, verdict)``.

    A fitting fixed rule decides; else the mined rules; else ``default``, so only rules for other verdicts are kept.
    ``labels`` has ``verdict`` and the page's id; all labelled pages are counted (``telling_rules``). A page with two
    verdicts counts for both. A null or malformed URL has empty host, path and tokens and gets the default. Each
    distinct URL is judged once, so repeated rows agree; rows without an id are judged too. An empty table gives no
    rows; other columns are not read.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"))
    known = labels.select(F.col(label_id_col).cast("long").alias("page_id"), "verdict").dropDuplicates()
    url = F.coalesce("url", F.lit(""))
    labelled = rows.join(known, "page_id").select(url.alias("url"), tokens(url).alias("tokens"), "verdict")
    mined = stored(telling_rules(labelled, default, **settings), "url-rules")
    urls = rows.select(F.coalesce("url", F.lit("")).alias("row")).distinct()
    found = predicted(urls.select("row", tokens(F.col("row")).alias("tokens")), mined)
    name, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = rows.join(found, F.coalesce("url", F.lit("")) == F.col("row"), "left")
    parsed = judged.select(
        "page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "mined"
    )
    said = F.coalesce(verdict, "mined", F.lit(default)).alias("verdict")
    return parsed.select("page_id", "url", "host", "path", name.alias("rule"), said)
