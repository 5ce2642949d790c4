"""State by key bucket: the newest event per key, in one folder per bucket of keys.

A key's bucket is a hash of it modulo a fixed number. A batch reads, merges and rewrites the
buckets that its keys fall in, by dynamic partition overwrite; the files of all other buckets
stay as they are. What a batch writes is staged first and then swapped in, which the next
writer or reader finishes if one dies on the way. One writer per table; readers run between
batches.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import names
from tidemark.operators.state import latest_per_key
from tidemark.schemas import SEQ, TS
from tidemark.sources import tables

# Buckets of a new table. A bucket is merged by one task, so it should stay below about a gigabyte.
BUCKETS = 64

_NAME = re.compile(r"bucket_of_(\d+)")


def bucket_column(buckets: int) -> str:
    """The partition column of a table with that many buckets."""
    return f"bucket_of_{buckets}"


def bucket_of(keys: str | Sequence[str], buckets: int) -> Column:
    """The bucket of a key, whatever integer or other type its columns have in a batch."""
    as_text = [F.col(k).cast("string") for k in names(keys)]
    return F.pmod(F.xxhash64(*as_text), F.lit(buckets)).cast("int")


def layout(spark: SparkSession, path: str) -> int | None:
    """How many buckets a table has; None if nothing has been written yet."""
    for name in tables.folders(spark, path):
        if found := _NAME.match(name):
            return int(found[1])
    return None


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    """Newest event per key, deletes included as markers; None if there is no table."""
    _finish(spark, path)
    buckets = layout(spark, path)
    if buckets is None:
        return None
    return tables.read_partitions(spark, path).drop(bucket_column(buckets))


def _finish(spark: SparkSession, path: str) -> None:
    buckets = layout(spark, path) or layout(spark, f"{path.rstrip('/')}-staged")
    if buckets:
        tables.swap(spark, path, [bucket_column(buckets)])


def upsert(
    changes: DataFrame,
    path: str,
    keys: str | Sequence[str],
    ts: str = TS,
    seq: str | Sequence[str] = SEQ,
    buckets: int = BUCKETS,
) -> list[int]:
    """Merge changes into the state, delete markers kept; returns the buckets rewritten.

    Changes shrink to one row per key before anything else, so a hot key costs one row. The
    driver sees bucket numbers only. The number of buckets is that of the first batch. Merging
    the same changes again leaves the rows as they are; no changes write nothing.
    """
    spark, keys = changes.sparkSession, names(keys)
    _finish(spark, path)
    buckets = layout(spark, path) or buckets
    column = bucket_column(buckets)
    newest = latest_per_key(changes, keys, ts, seq).withColumn(column, bucket_of(keys, buckets))
    newest = newest.persist()
    try:
        touched = sorted(r[0] for r in newest.select(column).distinct().collect())
        if not touched:
            return touched
        merged = newest
        if layout(spark, path) is not None:
            before = tables.read_partitions(spark, path).where(F.col(column).isin(touched))
            merged = before.unionByName(newest, allowMissingColumns=True)
        # Dealt by bucket once: ranking and writing keep to it, and a bucket is one file.
        merged = latest_per_key(merged.repartition(column), [column, *keys], ts, seq)
        tables.stage(merged, path, [column])
    finally:
        newest.unpersist()
    tables.swap(spark, path, [column])
    return touched
