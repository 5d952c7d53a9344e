"""Reply trees as training conversations: root-to-leaf paths by iterative self-joins, ranked, formatted with a loss mask.

Only DataFrame functions. A turn is written as ``<|im_start|>role`` newline text ``<|im_end|>`` newline. Control
strings inside texts get a backslash after their first character (one more if they carry some already), so markers
are unambiguous and ``unescape`` restores every text exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
# Control strings of common chat templates: what follows the first character `<` or `[`.
CONTROL_TAILS = r"\||/?s>|/?INST\]|/?SYS>"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)(?={CONTROL_TAILS})", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)(?={CONTROL_TAILS})", "$1$2")


def escape_role(role: Column) -> Column:
    """A role stands on one line, so its line ends and backslashes are written with a backslash."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    bare = unescape(role)
    return F.array_join(
        F.transform(
            F.split(bare, r"\\\\", -1), lambda part: F.replace(part, F.lit("\\n"), F.lit("\n"))
        ),
        "\\",
    )


def chain(conversations: DataFrame) -> DataFrame:
    """Rows ``(conv_id, turn, role, text)`` as a tree in which each row answers the one before.

    Rows are taken by turn, rows of one turn by role and text; null turns come first, null roles and texts are empty.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("tree"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    node = F.row_number().over(order).cast("long")
    return rows.select("tree", node.alias("node"), "role", "text").select(
        "tree",
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def paths(messages: DataFrame) -> DataFrame:
    """``(tree, leaf, node, height)``: every node on the way from each leaf to its root, the leaf at height 0.

    Self-joins with jumps that double: after n rounds a path is known up to 2^n nodes, so the number of rounds is the
    logarithm of the deepest tree. A message whose parent does not exist is a root; messages that only reach each
    other in a circle have no leaf and are left out. Rows equal in tree and node are one message, with the least parent
    (null first).
    """
    nodes = messages.groupBy("tree", "node").agg(F.min(F.struct("parent")).alias("least"))
    nodes = nodes.select("tree", "node", "least.parent")
    known = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    hop = nodes.join(
        known, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("n"))
    ).select("tree", "node", F.col("n").alias("up"))
    hop = stored(hop, "reply-hops")
    answered = hop.select(F.col("tree").alias("t"), F.col("up").alias("n")).distinct()
    leaves = nodes.join(
        answered, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")), "left_anti"
    )
    found = stored(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("height")), "reply-paths")
    distance = 1
    while True:
        step = hop.select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        matched = F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))
        above = found.join(step, matched).select(
            "tree", "leaf", F.col("up").alias("node"), (F.col("height") + distance).alias("height")
        )
        above = stored(above, "reply-paths")
        if above.isEmpty():
            return found
        found = found.union(above)
        second = hop.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("top"))
        hop = stored(
            hop.join(second, F.col("tree").eqNullSafe(F.col("t")) & (F.col("up") == F.col("n"))).select(
                "tree", "node", F.col("top").alias("up")
            ),
            "reply-hops",
        )
        distance *= 2


def conversations(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """One formatted conversation per chosen path of each tree.

    ``messages``: ``(tree, node, parent, role, text, score)``; the parent of a root is null. Paths of a tree are
    ranked by mean score, then length, then leaf; ``branches`` are kept, all if None. Result: ``(tree, leaf, rank,
    score, n_turns, formatted, loss_spans)``; a loss span is ``(start, length)`` in code points of ``formatted`` and
    covers exactly one text of the trained role. Null roles and texts are empty, null scores count as 0. Rows equal in
    tree and node are one message: the least by parent (null first), role, text and score. An empty table gives no
    rows; other columns are not read.
    """
    row = F.struct(
        "parent",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("points"),
    )
    once = messages.groupBy(F.col("tree").alias("t"), F.col("node").alias("n")).agg(F.min(row).alias("row"))
    said = once.select(
        "t",
        "n",
        "row.role",
        F.concat(F.lit(TURN_START), escape_role(F.col("row.role")), F.lit("\n")).alias("head"),
        escape(F.col("row.text")).alias("body"),
        "row.points",
    )
    turns = paths(messages).join(
        said, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))
    )
    if branches is not None:
        mean = turns.groupBy("tree", "leaf").agg(F.avg("points").alias("score"), F.count("*").alias("n_turns"))
        best = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("n_turns"), "leaf")
        chosen = mean.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
        chosen = chosen.select(F.col("tree").alias("ct"), F.col("leaf").alias("cl"), "rank")
        turns = turns.join(chosen, F.col("tree").eqNullSafe(F.col("ct")) & (F.col("leaf") == F.col("cl")))
    else:
        turns = turns.withColumn("rank", F.lit(None).cast("int"))
    grouped = turns.groupBy("tree", "leaf", "rank").agg(
        F.avg("points").alias("score"),
        F.count("*").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct((-F.col("height")).alias("at"), "role", "head", "body"))).alias("turns"),
    )
    sizes = F.transform(
        F.col("turns"),
        lambda t: F.struct(
            (t["role"] == F.lit(TRAINED_ROLE)).alias("trained"),
            F.length(t["head"]).alias("head"),
            F.length(t["body"]).alias("body"),
        ),
    )
    after = len(TURN_END) + 1
    empty = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")
    )
    spans = F.aggregate(
        sizes,
        empty,
        lambda acc, t: F.struct(
            (acc["at"] + t["head"] + t["body"] + F.lit(after)).alias("at"),
            F.when(
                t["trained"],
                F.array_append(
                    acc["spans"],
                    F.struct((acc["at"] + t["head"]).alias("start"), t["body"].alias("length")),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    body = F.array_join(
        F.transform(F.col("turns"), lambda t: F.concat(t["head"], t["body"], F.lit(TURN_END + "\n"))), ""
    )
    return grouped.select(
        "tree", "leaf", "rank", "score", "n_turns", body.alias("formatted"), spans.alias("loss_spans")
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of ``(role, text)``, unescaped."""
    parts = F.slice(F.split(formatted, r"<\|im_start\|>", -1), 2, 1 << 30)
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(
                F.substring(
                    p,
                    F.length(F.substring_index(p, "\n", 1)) + 2,
                    F.length(p) - F.length(F.substring_index(p, "\n", 1)) - 2 - len(TURN_END),
                )
            ).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), ""
    )


def readback(formatted: DataFrame) -> DataFrame:
    """The digests of each formatted conversation, from what its text and mask say."""
    turns = read_turns(F.col("formatted"))
    rows = formatted.select(
        F.col("tree").alias("conv_id"), "formatted", turns.alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")
    )
    text = F.array_join(
        F.transform(F.col("turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
