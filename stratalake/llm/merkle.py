"""Merkle manifest of a dataset: a digest per row, per group and for the whole, and a proof for every row.

Rows of a group are leaves in ascending order of their id; runs of 16 consecutive nodes hash to their parent until
one is left, the group's own root. The groups' roots, in the order of the groups, hash to the root likewise. A lone
node is never hashed again.

Proofs come by pointer jumping. A node holds the siblings on its way to an ancestor, at first its parent; one
self-join appends what the ancestor holds and moves to the ancestor's ancestor, so the distance doubles each round.
Leaves join last, since a run's sixteen leaves share all but the first step: long ways are held once a run.

Nulls: a null value hashes as ``-``, a null group is a group of its own and goes first, null ids go first. Rows with
equal ids go by their digests, and rows equal in both are the same leaf twice: two places, each with its own proof.
No rows give no rows. Columns beside those named are left alone and may have any name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 16
STEP = "array<struct<left:string,right:string>>"


def leaf(values: Sequence[Column]) -> Column:
    """SHA-256 over the values in turn: ``-`` if null, else the length in UTF-8 bytes, a colon and the text."""
    texts = [value.cast("string") for value in values]
    written = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*written), 256)


def _key(level: Column | int, idx: Column, tree: Column) -> Column:
    return F.concat_ws("/", F.lit(level).cast("string") if isinstance(level, int) else level, idx.cast("string"), tree)


def _levels(most: int) -> int:
    """How often ``most`` nodes are hashed in runs until one is left."""
    levels = 0
    while most > 1:
        most, levels = -(-most // FAN), levels + 1
    return levels


def _runs(nodes: DataFrame, rounds: int) -> tuple[DataFrame, DataFrame]:
    """``(parents, tops)`` of trees whose lowest nodes are ``(tree, idx, n, digest, node)``: every run with its
    ``children`` in order, and the last node of each tree."""
    made, tops = None, nodes.where("n = 1").select("tree", "digest", "node")
    for level in range(1, rounds + 1):
        child = F.struct((F.col("idx") % FAN).alias("place"), "digest", "node")
        parents = (
            nodes.where("n > 1")
            .groupBy("tree", F.expr(f"idx div {FAN}").alias("idx"), F.ceil(F.col("n") / FAN).cast("long").alias("n"))
            .agg(F.sort_array(F.collect_list(child)).alias("children"))
            .select(
                "*",
                F.sha2(F.concat_ws("", "children.digest"), 256).alias("digest"),
                _key(level, F.col("idx"), F.col("tree")).alias("node"),
            )
        )
        nodes = stored(parents, "runs")
        made = nodes if made is None else made.union(nodes)
        tops = tops.union(nodes.where("n = 1").select("tree", "digest", "node"))
    if made is None:
        made = nodes.limit(0).select(
            "tree", "idx", "n", F.array(F.struct(F.lit(0).cast("long").alias("place"), "digest", "node")).alias("children"),
            "digest", "node",
        )
    return made, tops


def _step(children: str, place: str) -> str:
    """The siblings of the child at ``place``: those on its left, those on its right."""
    digests = f"transform({children}, c -> c.digest)"
    left = f"concat_ws('', slice({digests}, 1, cast({place} AS INT)))"
    return f"named_struct('left', {left}, 'right', concat_ws('', slice({digests}, cast({place} AS INT) + 2, {FAN})))"


def proofs(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "source",
    fields: Sequence[str] = FIELDS,
    also: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``(id, group, leaf, subroot, root, path, *also)`` per row of ``docs``.

    ``path`` has a step per level from the leaf's run to the root, the siblings' digests on the left and on the right,
    concatenated. ``also`` adds columns computed from the row, to carry them beside its proof. ``id_col`` and
    ``group_col`` keep their names.
    """
    also = dict(also or {})
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-"))
    hashed = stored(
        docs.select(
            F.col(id_col).alias("__id"),
            F.col(group_col).alias("__group"),
            group.alias("tree"),
            leaf([F.col(name) for name in fields]).alias("digest"),
            *[value.alias(f"__also_{name}") for name, value in also.items()],
        ),
        "leaves",
    )
    leaves = stored(
        numbered(hashed, ["__id", "digest"], ["tree"])
        .withColumnsRenamed({"__place": "idx", "__size": "n"})
        .withColumn("node", _key(0, F.col("idx"), F.col("tree"))),
        "ordered-leaves",
    )
    low_rounds = _levels(leaves.agg(F.max("n")).first()[0] or 0)
    low, tops = _runs(leaves.select("tree", "idx", "n", "digest", "node"), low_rounds)
    # A null group is written "-", all others begin with "=", which is greater.
    entries = stored(
        numbered(stored(tops, "subroots"), ["tree"])
        .select(F.lit("").alias("tree"), F.col("__place").alias("idx"), F.col("__size").alias("n"), "digest", "node"),
        "entries",
    )
    high_rounds = _levels(entries.agg(F.max("n")).first()[0] or 0)
    high, root = _runs(entries, high_rounds)

    steps = (
        low.select("node", "children", F.lit(False).alias("top"))
        .union(high.select("node", "children", F.col("node").startswith("1/").alias("top")))
        .where("NOT startswith(children[0].node, '0/') OR top")
        .select("node", "children", "top", F.posexplode("children").alias("pos", "child"))
    )
    ways = stored(
        steps.select(
            F.col("child.node").alias("node"),
            F.col("node").alias("ancestor"),
            F.array(F.expr(_step("children", "pos"))).cast(STEP).alias("path"),
            F.when(F.col("top"), F.col("child.digest")).alias("subroot"),
        ),
        "steps",
    )
    distance = 1
    while distance < low_rounds + high_rounds:
        onward = ways.selectExpr("node AS ancestor", "ancestor AS further", "path AS rest", "subroot AS found")
        ways = stored(
            ways.join(onward, "ancestor", "left").select(
                "node",
                F.coalesce("further", "ancestor").alias("ancestor"),
                F.concat("path", F.coalesce("rest", F.array().cast(STEP))).alias("path"),
                F.coalesce("subroot", "found").alias("subroot"),
            ),
            "ways",
        )
        distance *= 2

    first_runs = low.where("startswith(node, '1/')").select("node", "children")
    above = first_runs.join(ways, "node", "left").select("node", "children", "path", "subroot")
    lone = ways.where("startswith(node, '0/')").select("node", F.lit(None).cast(above.schema["children"].dataType), "path", "subroot")
    above = stored(above.union(lone), "above").withColumnRenamed("node", "run")
    run = F.when(F.col("n") > 1, _key(1, F.expr(f"idx div {FAN}"), F.col("tree"))).otherwise(F.col("node"))
    own = F.when(F.col("children").isNotNull(), F.array(F.expr(_step("children", f"idx % {FAN}")))).otherwise(F.array())
    return (
        leaves.withColumn("run", run)
        .join(above, "run", "left")
        .crossJoin(F.broadcast(root.select(F.col("digest").alias("__root"))))  # one row
        .select(
            F.col("__id").alias(id_col),
            F.col("__group").alias(group_col),
            F.col("digest").alias("leaf"),
            F.coalesce("subroot", "__root").alias("subroot"),
            F.col("__root").alias("root"),
            F.concat(own.cast(STEP), F.coalesce("path", F.array().cast(STEP))).alias("path"),
            *[F.col(f"__also_{name}").alias(name) for name in also],
        )
    )


def folded(digest: Column, path: Column) -> Column:
    """The root that ``digest`` gives with the siblings on ``path``."""
    return F.aggregate(path, digest, lambda found, step: F.sha2(F.concat(step["left"], found, step["right"]), 256))


def siblings(path: Column) -> Column:
    """All siblings on ``path`` as one text."""
    return F.concat_ws("", F.transform(path, lambda step: F.concat(step["left"], step["right"])))
