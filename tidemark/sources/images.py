"""Stored images of a table: digests to compare two of them by, and states to replay from.

An image is stored by key bucket, with a digest per bucket beside it. Two images of one number
of buckets are compared by their digests first; rows are read only of buckets that differ.
A state index keeps the states of an event log at chosen times; a state in between is the
nearest one before it and the events since.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import names
from tidemark.operators.capture import snapshot_diff
from tidemark.operators.state import latest_per_key, merge_changes, without_deletes
from tidemark.schemas import OP, SEQ, TS
from tidemark.sources import tables
from tidemark.sources.buckets import bucket_column, bucket_of

# Buckets of an image: enough that a few changes touch a small share of them.
BUCKETS = 64


# -- digests -------------------------------------------------------------------------


def row_hash(columns: Sequence[str]) -> Column:
    """A hash of a row's values in a fixed order of columns; a null is a value of its own."""
    ordered = sorted(columns)
    return F.xxhash64(*[F.col(c) for c in ordered], *[F.col(c).isNull() for c in ordered])


def digests(df: DataFrame, column: str) -> DataFrame:
    """Per value of ``column`` a digest of its rows that their order does not change.

    Rows, exclusive or and sum of the rows' hashes; partial sums are made before the shuffle.
    """
    hashed = df.select(column, row_hash([c for c in df.columns if c != column]).alias("_h"))
    return hashed.groupBy(F.col(column).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor("_h").alias("mixed"),
        F.sum(F.col("_h").cast("decimal(38,0)")).alias("total"),
    )


def save_image(df: DataFrame, path: str, keys: str | Sequence[str], buckets: int = BUCKETS) -> None:
    """Store a table by key bucket, and the digests of its buckets beside it."""
    column = bucket_column(buckets)
    rows = df.withColumn(column, bucket_of(keys, buckets))
    rows.repartition(column).write.mode("overwrite").partitionBy(column).parquet(f"{path}/rows")
    stored = read_image(df.sparkSession, path, df.columns)
    tables.replace(digests(stored, column), f"{path}/digests")


def read_image(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A stored image with its bucket column."""
    rows = tables.read_partitions(spark, f"{path}/rows")
    return rows.select(*columns, rows.columns[-1]) if columns else rows


def changed_buckets(spark: SparkSession, old: str, new: str) -> list[int]:
    """Buckets whose digests differ: at most as many numbers as there are buckets."""
    a, b = (tables.read_current(spark, f"{p}/digests") for p in (old, new))
    same = F.lit(True)
    for c in ("rows", "mixed", "total"):
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    both = a.alias("a").join(b.alias("b"), F.col("a.bucket") == F.col("b.bucket"), "full")
    return sorted(r[0] for r in both.where(~same).select(F.coalesce("a.bucket", "b.bucket")).collect())


def image_diff(
    spark: SparkSession, old: str, new: str, keys: str | Sequence[str], ts_ms: int
) -> DataFrame:
    """The ``c``, ``u`` and ``d`` events between two stored images, like ``snapshot_diff``.

    Only the folders of buckets whose digests differ are read, and there every row is compared.
    Both images have the same columns and number of buckets.
    """
    before, after = read_image(spark, old), read_image(spark, new)
    column = after.columns[-1]
    if before.columns[-1] != column:
        raise ValueError(f"images of {before.columns[-1]} and {column} cannot be compared")
    touched = F.col(column).isin(changed_buckets(spark, old, new))
    return snapshot_diff(
        before.where(touched).drop(column), after.where(touched).drop(column), keys, ts_ms
    )


# -- states at chosen times --------------------------------------------------------------


def save_state(
    log: DataFrame,
    path: str,
    at: int,
    day: str,
    keys: str | Sequence[str],
    ts: str = TS,
    seq: str | Sequence[str] = SEQ,
) -> None:
    """Keep the state of a log at ``at`` (epoch ms, inclusive), deletes as markers.

    ``day`` is the log's partition column of arrival, which never goes back. The index notes the
    first day that a later time has to be replayed from: the earliest one with an event after
    ``at``, or the last day so far, which late events may still join.
    """
    spark = log.sparkSession
    state = latest_per_key(log.where(F.col(ts) <= at), keys, ts, seq).drop(day)
    state.write.mode("overwrite").parquet(f"{path}/state-{at}")
    first = F.least(F.min(F.when(F.col(ts) > at, F.col(day))), F.max(day))
    noted = log.agg(first.alias("replay_from")).select(F.lit(at).cast("bigint").alias("at"), "replay_from")
    tables.append(noted, f"{path}/index")


def nearest_state(spark: SparkSession, path: str, as_of: int) -> tuple[int, object] | None:
    """Time and first day to replay of the newest kept state that is no later than ``as_of``."""
    if not tables.exists(spark, f"{path}/index"):
        return None
    index = tables.read(spark, f"{path}/index").where(F.col("at") <= as_of)
    found = index.orderBy(F.desc("at"), F.asc_nulls_first("replay_from")).first()
    return None if found is None else (found["at"], found["replay_from"])


def state_as_of(
    log: DataFrame,
    path: str,
    as_of: int,
    day: str,
    keys: str | Sequence[str],
    ts: str = TS,
    seq: str | Sequence[str] = SEQ,
    op: str = OP,
) -> DataFrame:
    """Rows that existed at ``as_of``: the nearest kept state and the events since.

    Days of the log before the state's first day to replay are not opened. Events that came
    late, for times before the kept state, are on later days and so are replayed too. Without a
    kept state that early, the whole log is.
    """
    spark, keys = log.sparkSession, names(keys)
    found = nearest_state(spark, path, as_of)
    events = log.where(F.col(ts) <= as_of)
    if found is None:
        return without_deletes(latest_per_key(events, keys, ts, seq).drop(day), op)
    at, replay_from = found
    kept = spark.read.parquet(f"{path}/state-{at}")
    if replay_from is not None:
        events = events.where(F.col(day) >= F.lit(replay_from))
    return without_deletes(merge_changes(kept, events.drop(day), keys, ts, seq), op)
