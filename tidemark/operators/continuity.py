"""What a topic's log holds: ranges of offsets read, offsets missing, offsets read again.

A topic partition is a single sequence of any length. Its offsets are cut into blocks, so runs
and gaps inside a block are found by many tasks; what crosses a block's end is settled on
one row per block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import names

BY, OFFSET = ("topic", "partition"), "offset"

# Offsets of one block.
BLOCK = 1 << 20

_BLOCK, _TIMES = "_block", "_times"


def _delivered(messages: DataFrame, by: list[str], offset: str, block: int) -> DataFrame:
    """One row per offset, with its block and how often it was read; null offsets play no part."""
    counted = messages.where(F.col(offset).isNotNull()).groupBy(*by, offset)
    number = F.floor(F.col(offset) / F.lit(block)).cast("bigint")
    return counted.agg(F.count(F.lit(1)).alias(_TIMES)).withColumn(_BLOCK, number)


def read_again(
    messages: DataFrame, by: str | Sequence[str] = BY, offset: str = OFFSET
) -> DataFrame:
    """Offsets that were read more than once: by, offset, times."""
    found = messages.where(F.col(offset).isNotNull()).groupBy(*names(by), offset)
    return found.agg(F.count(F.lit(1)).alias("times")).where("times > 1")


def missing(
    messages: DataFrame,
    by: str | Sequence[str] = BY,
    offset: str = OFFSET,
    first: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """Gaps between the offsets read: by, first_missing, last_missing, n.

    Gaps lie between two offsets of a partition, or before its first one if ``first`` says
    where the topic begins.
    """
    by = names(by)
    seen = _delivered(messages, by, offset, block)
    inside = F.lag(offset).over(Window.partitionBy(*by, _BLOCK).orderBy(offset))
    within = seen.select(*by, inside.alias("_before"), F.col(offset).alias("_at"))
    ends = seen.groupBy(*by, _BLOCK).agg(F.min(offset).alias("_at"), F.max(offset).alias("_last"))
    begin = F.lit(None if first is None else first - 1).cast("bigint")
    previous = F.lag("_last", 1).over(Window.partitionBy(*by).orderBy(_BLOCK))
    across = ends.select(*by, F.coalesce(previous, begin).alias("_before"), "_at")
    gaps = within.unionByName(across).where(F.col("_at") - F.col("_before") > 1)
    return gaps.select(
        *by,
        (F.col("_before") + 1).alias("first_missing"),
        (F.col("_at") - 1).alias("last_missing"),
        (F.col("_at") - F.col("_before") - 1).alias("n"),
    )


def ranges(
    messages: DataFrame, by: str | Sequence[str] = BY, offset: str = OFFSET, block: int = BLOCK
) -> DataFrame:
    """Runs of offsets without a gap: by, first_offset, last_offset, messages.

    ``messages`` counts repeated deliveries too. Runs that touch neither end of their block are
    final; of each block only the two that do are joined to those of its neighbours.
    """
    by = names(by)
    seen = _delivered(messages, by, offset, block)
    number = F.row_number().over(Window.partitionBy(*by, _BLOCK).orderBy(offset))
    runs = (
        seen.withColumn("_run", F.col(offset) - number)
        .groupBy(*by, _BLOCK, "_run")
        .agg(
            F.min(offset).alias("first_offset"),
            F.max(offset).alias("last_offset"),
            F.sum(_TIMES).alias("messages"),
        )
    )
    out = [*by, "first_offset", "last_offset", "messages"]
    touches = (F.col("first_offset") == F.col(_BLOCK) * block) | (
        F.col("last_offset") == F.col(_BLOCK) * block + block - 1
    )
    order = Window.partitionBy(*by).orderBy("first_offset")
    starts = ~F.coalesce(F.lag("last_offset").over(order) + 1 == F.col("first_offset"), F.lit(False))
    joined = (
        runs.where(touches)
        .withColumn("_starts", starts.cast("int"))
        .withColumn("_group", F.sum("_starts").over(order))
        .groupBy(*by, "_group")
        .agg(
            F.min("first_offset").alias("first_offset"),
            F.max("last_offset").alias("last_offset"),
            F.sum("messages").alias("messages"),
        )
    )
    return runs.where(~touches).select(*out).unionByName(joined.select(*out))
