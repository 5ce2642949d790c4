"""Change events made from table snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import names
from tidemark.schemas import TOPIC_PREFIX


def _whole(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.struct(*[df[c] for c in columns])


def snapshot_events(df: DataFrame, ts_ms: int | Column) -> DataFrame:
    """Every row of a table as an ``r`` event: op, ts_ms, before, after."""
    ts = ts_ms if isinstance(ts_ms, Column) else F.lit(ts_ms)
    after = _whole(df, df.columns)
    return df.select(
        F.lit("r").alias("op"),
        ts.cast("bigint").alias("ts_ms"),
        F.when(F.lit(False), after).alias("before"),
        after.alias("after"),
    )


def snapshot_diff(
    old: DataFrame, new: DataFrame, keys: str | Sequence[str], ts_ms: int
) -> DataFrame:
    """The ``c``, ``u`` and ``d`` events that turn ``old`` into ``new``.

    Keys are primary keys: unique and not null. Both images are whole rows.
    """
    keys = names(keys)
    columns = new.columns
    left = old.select(*keys, _whole(old, columns).alias("before"))
    right = new.select(*keys, _whole(new, columns).alias("after"))
    return (
        left.join(right, keys, "full")
        .where(~F.col("before").eqNullSafe(F.col("after")))
        .select(
            F.when(F.col("before").isNull(), "c")
            .when(F.col("after").isNull(), "d")
            .otherwise("u")
            .alias("op"),
            F.lit(ts_ms).cast("bigint").alias("ts_ms"),
            "before",
            "after",
        )
    )


def row_image(after: str = "after", before: str = "before") -> Column:
    """The row an event speaks of: the new image, or the old one of a delete."""
    return F.coalesce(F.col(after), F.col(before))


def envelope_json(wrapped: Column | bool = True) -> Column:
    """The JSON text of an event (op, ts_ms, before, after).

    A ``wrapped`` event sits under ``payload``, the others stand for themselves.
    """
    wrapped = wrapped if isinstance(wrapped, Column) else F.lit(wrapped)
    keep_nulls = {"ignoreNullFields": "false"}
    event = F.struct("op", "ts_ms", "before", "after")
    return F.when(wrapped, F.to_json(F.struct(event.alias("payload")), keep_nulls)).otherwise(
        F.to_json(event, keep_nulls)
    )


def to_envelopes(
    events: DataFrame,
    table: str,
    offset: Column,
    wrapped: Column | bool = True,
    partition: Column | int = 0,
    prefix: str = TOPIC_PREFIX,
) -> DataFrame:
    """Events (op, ts_ms, before, after) as topic messages with JSON values."""
    partition = partition if isinstance(partition, Column) else F.lit(partition)
    return events.select(
        F.lit(prefix + table).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        envelope_json(wrapped).cast("binary").alias("value"),
    )
