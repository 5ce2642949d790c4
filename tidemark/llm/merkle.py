"""Merkle manifest of a table: a tree of digests per group, and a proof for each row.

Rows of a group get their rank by a range partition, per-part counts and a window inside each
part. The digits of the rank say where a leaf hangs. Within a block of ``FANOUT ** DIGITS``
leaves they are grouped away one after another, each grouping nesting the child structs under
their parent, all on the partitioning of one shuffle. Blocks are the nodes of the next tier, so
a block's nested struct has a bounded size whatever the group's. Proofs come out of the way
back: transforms and explodes open the nested structs from the top, each step adding the
siblings beside a child; what lies above a block is grouped together with it, not joined to
leaves.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import stored

#: Children of a node, and levels that a block nests (243 leaves).
FANOUT, DIGITS = 3, 5

_LEVELS = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated as UTF-8."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon and value, so that no two rows concatenate alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    """The digest of a row of these values."""
    return digest(*[field(v) for v in values])


def folded(leaf: Column, levels: Column) -> Column:
    """The root that a leaf and the siblings of its path, lowest level first, lead to."""
    return F.aggregate(levels, leaf, lambda h, at: digest(at["before"], h, at["after"]))


def proof_digest(levels: Column) -> Column:
    """The digest of all siblings of a path, level by level, left to right."""
    beside = F.transform(levels, lambda at: F.concat(at["before"], at["after"]))
    return F.sha2(F.array_join(beside, ""), 256)


def _ranked(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` (tree, hash, payload and the columns of ``order``) as tree, rank, left, hash, payload.

    ``left`` is the height of the node's tree: how often its nodes must be grouped to be one.
    Rows are dealt by ranges of (tree, order), so a tree of any size spreads over all tasks.
    """
    place = [*order, "hash", "_row"]
    fixed = stored(nodes.withColumn("_row", F.monotonically_increasing_id()), "merkle-nodes")
    parts = stored(
        fixed.repartitionByRange("tree", *place).withColumn("_part", F.spark_partition_id()),
        "merkle-ordered",
    )
    within = Window.partitionBy("tree")
    earlier = within.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        parts.groupBy("tree", "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            F.col("tree").alias("_tree"), F.col("_part").alias("_at"),
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_earlier"),
            F.sum("_n").over(within).alias("_all"),
        )
    )
    powers = F.array(*[F.lit(FANOUT**i) for i in range(39)])
    number = F.row_number().over(Window.partitionBy("_part", "tree").orderBy(*place))
    return (
        parts.withColumn("_number", number)
        .join(counts, (F.col("_part") == F.col("_at")) & F.col("tree").eqNullSafe(F.col("_tree")))
        .select(
            "tree",
            (F.col("_earlier") + F.col("_number") - 1).alias("rank"),
            F.size(F.filter(powers, lambda p: p < F.col("_all"))).alias("left"),
            "hash",
            "payload",
        )
    )


def _rolled(nodes: DataFrame) -> DataFrame:
    """One row per block of ``nodes``: tree, block, left and ``top``, the struct nested over it.

    One shuffle deals blocks to tasks; the groupings keep to it.
    """
    digits = [f"_d{j}" for j in range(DIGITS)]
    split = nodes.select(
        "tree", F.expr(f"rank div {FANOUT**DIGITS} AS block"), "left", "hash", "payload",
        *[F.expr(f"CAST(rank div {FANOUT**j} % {FANOUT} AS INT) AS {d}") for j, d in enumerate(digits)],
    ).repartition("tree", "block")
    kid = F.struct(F.col("_d0").alias("digit"), "hash", "payload")
    for j in range(DIGITS):
        above = digits[j + 1 :]
        grouped = split.groupBy("tree", "block", "left", *above).agg(
            F.sort_array(F.collect_list(kid)).alias("kids")
        )
        run = F.sha2(F.array_join(F.transform("kids", lambda k: k["hash"]), ""), 256)
        # A tree that is one node already grows no further: its only child is the node.
        split = grouped.withColumn("hash", F.when(F.col("left") > j, run).otherwise(F.col("kids")[0]["hash"]))
        place = F.col(above[0]) if above else F.lit(0)
        kid = F.struct(place.alias("digit"), "hash", "kids")
    return split.select("tree", "block", "left", F.struct("hash", "kids").alias("top"))


def _tiers(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of the nodes, blocks of those blocks, and so on until each tree is one block."""
    tiers = [stored(_rolled(nodes), "merkle-tier")]
    while (tiers[-1].agg(F.max("block")).first()[0] or 0) > 0:
        upper = tiers[-1].select(
            "tree",
            F.col("block").alias("rank"),
            F.greatest(F.col("left") - DIGITS, F.lit(0)).alias("left"),
            F.col("top.hash").alias("hash"),
            F.lit(None).cast("int").alias("payload"),
        )
        tiers.append(stored(_rolled(upper), "merkle-tier"))
    return tiers


def _siblings(kids: Column, grows: Column) -> Column:
    """The children, each with the level it adds to its path: the hashes beside it, if any grew."""
    hashes = F.transform(kids, lambda k: k["hash"])

    def beside(k: Column, i: Column) -> Column:
        level = F.struct(
            F.array_join(F.slice(hashes, 1, i), "").alias("before"),
            F.array_join(F.slice(hashes, i + 2, F.lit(FANOUT)), "").alias("after"),
        )
        return F.struct(
            k.alias("kid"), F.when(grows, F.array(level)).otherwise(F.array().cast(_LEVELS)).alias("level")
        )

    return F.transform(kids, beside)


def _opened(blocks: DataFrame) -> DataFrame:
    """The nodes of blocks with their paths: tree, rank, hash, payload, levels, roots.

    ``blocks`` has, beside the nested struct, the ``levels`` above the block and ``roots``.
    """
    rank = F.col("block")
    at = blocks.select("tree", "left", "roots", "levels", rank.alias("rank"), F.col("top").alias("kid"))
    for j in reversed(range(DIGITS)):
        beside = _siblings(F.col("kid.kids"), F.col("left") > j)
        at = at.select("tree", "left", "roots", "levels", "rank", F.explode(beside).alias("at")).select(
            "tree", "left", "roots",
            F.concat("at.level", "levels").alias("levels"),
            (F.col("rank") * FANOUT + F.col("at.kid.digit")).alias("rank"),
            F.col("at.kid").alias("kid"),
        )
    return at.select(
        "tree", "rank", "levels", "roots",
        F.col("kid.hash").alias("hash"), F.col("kid.payload").alias("payload"),
    )


def _with_paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Blocks with the path above each: one group of two rows, the block and its path."""
    both = blocks.withColumn("above", F.lit(None)).unionByName(
        above.select("tree", F.col("rank").alias("block"), F.struct("levels", "roots").alias("above")),
        allowMissingColumns=True,
    )
    grouped = both.groupBy("tree", "block").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("left", "top", "above")]
    )
    return grouped.select("tree", "block", "left", "top", "above.levels", "above.roots")


def manifest(
    rows: DataFrame, order: str, group: str, leaf: str = "leaf", carry: Sequence[str] = ()
) -> DataFrame:
    """One row per row: ``order``, ``group``, leaf, ``carry``, subroot, root and levels.

    The leaves of a group ascend by ``order`` (nulls first; rows that repeat it by their
    digest). While a group has several nodes, every three consecutive ones become their
    digest, the last run being shorter, even a single node. What remains is the group's
    subroot; subroots, ordered by group (null, a group like others, first), give the root the
    same way. ``levels`` is the path from the leaf through its subroot to the root, lowest
    first: the digests beside the node, concatenated, before and after it. A leaf alone in its
    group has no level there. An empty table gives an empty result; columns not named play no
    part, and the names of the others do not matter.
    """
    keep = [order, group, *carry]
    payload = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)])
    nodes = rows.select(
        F.col(group).alias("tree"), F.col(order).alias("_order"),
        F.col(leaf).alias("hash"), payload.alias("payload"),
    )
    trees = _tiers(_ranked(nodes, ["_order"]))
    subroots = trees[-1].select(
        F.lit(0).alias("tree"), F.col("tree").alias("_order"), F.col("top.hash").alias("hash"),
        F.struct(F.col("tree").alias("of")).alias("payload"),
    )
    forest = _tiers(_ranked(subroots, ["_order"]))
    at = forest[-1].withColumns(
        {
            "levels": F.array().cast(_LEVELS),
            "roots": F.struct(F.lit(None).cast("string").alias("subroot"), F.col("top.hash").alias("root")),
        }
    )
    paths = reduce(lambda at, lower: _with_paths(lower, _opened(at)), reversed(forest[:-1]), at)
    paths = _opened(paths).select(
        F.col("payload.of").alias("tree"), F.lit(0).cast("long").alias("rank"), "levels",
        F.struct(F.col("hash").alias("subroot"), F.col("roots.root").alias("root")).alias("roots"),
    )
    for lower in reversed(trees):
        paths = _opened(_with_paths(lower, paths))
    return paths.select(
        *[F.col(f"payload.c{i}").alias(c) for i, c in enumerate(keep)],
        F.col("hash").alias("leaf"), "roots.subroot", "roots.root", "levels",
    )
