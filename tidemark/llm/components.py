"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
    ).first()
    return row[0], row[1]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node with a link; the component is its smallest node.

    Each round links all larger neighbours of a node to its smallest one, then all smaller
    neighbours likewise, until every node hangs off the smallest of its component. Rounds
    grow with the logarithm of the longest chain. Minima are aggregated before they are
    shuffled, and the edges never leave the cluster; the driver sees a count and a
    checksum. Null ends, loops and repeated links are ignored; without links the result
    is empty.
    """
    edges = stored(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct(),
        "links",
    )
    before = _state(edges)
    while before[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (
            both.where(F.col("v") > F.col("u"))
            .join(least, "u")
            .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
            .where(F.col("hi") != F.col("lo"))
            .distinct()
        )
        large = stored(large, "large-star")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(least, "hi")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .where(F.col("hi") != F.col("lo"))
            .unionAll(least.select("hi", F.col("m").alias("lo")))
            .distinct()
        )
        edges = stored(small, "small-star")
        after = _state(edges)
        if after == before:
            break
        before = after
    members = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return members.unionAll(roots)
