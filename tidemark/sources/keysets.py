"""Sets of integer keys as exact bitmaps, to check a batch without reading the rows before it.

A bitmap covers 32,768 consecutive keys in 4 KB, so dense keys cost about a bit each. A key set
is a table (bucket, bitmap), kept beside the table whose keys it holds. Checks shuffle the
batch and the bitmaps, never the old rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import tables

# Bitmaps of one folder of a stored key set: at most 16 MB.
_SPAN = 4096


def key_set(df: DataFrame, key: str) -> DataFrame:
    """The keys of a table as (bucket, bitmap); null keys are in no set."""
    keys = df.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("k"))
    placed = keys.select(
        F.bitmap_bucket_number("k").alias("bucket"), F.bitmap_bit_position("k").alias("at")
    )
    return placed.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bitmap"))


def union_sets(*sets: DataFrame) -> DataFrame:
    """The keys of any of the sets."""
    together = reduce(DataFrame.unionByName, sets)
    return together.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def set_size(keys: DataFrame) -> DataFrame:
    """One row: how many keys a set has."""
    return keys.agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias("keys"))


def _holds(at: Column, bitmap: Column) -> Column:
    """Whether the bit at a position is set; false without a bitmap."""
    byte = F.conv(F.hex(F.substring(bitmap, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.get(F.array(*[byte.bitwiseAND(1 << i) > 0 for i in range(8)]), (at % 8).cast("int")), F.lit(False))


def with_membership(batch: DataFrame, key: str, keys: DataFrame, name: str) -> DataFrame:
    """``batch`` with ``name``: whether a row's key is in the set; null for a null key."""
    k = F.col(key).cast("bigint")
    placed = batch.withColumns({"_bucket": F.bitmap_bucket_number(k), "_at": F.bitmap_bit_position(k)})
    found = keys.select(F.col("bucket").alias("_bucket"), F.col("bitmap").alias("_bitmap"))
    held = F.when(F.col(key).isNotNull(), _holds(F.col("_at"), F.col("_bitmap")))
    return placed.join(found, "_bucket", "left").select(*batch.columns, held.alias(name))


def repeated_keys(batch: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """Keys of a batch that it holds more than once or that are known already."""
    counts = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    marked = with_membership(counts, key, known, "_known")
    return marked.where((F.col("_n") > 1) | F.col("_known")).select(key)


def orphans(batch: DataFrame, col: str, parents: DataFrame) -> DataFrame:
    """Rows of a batch whose reference is set and is not among the parents' keys."""
    return with_membership(batch, col, parents, "_known").where(~F.col("_known")).drop("_known")


# -- key sets on storage -----------------------------------------------------------------


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    tables.swap(spark, path, ["span"])
    return tables.read_partitions(spark, path) if tables.exists(spark, path) else None


def read_set(spark: SparkSession, path: str) -> DataFrame:
    """A stored key set; without a folder, the empty one."""
    known = _stored(spark, path)
    if known is None:
        return spark.createDataFrame([], "bucket bigint, bitmap binary")
    return known.select("bucket", "bitmap")


def add_keys(batch: DataFrame, key: str, path: str) -> None:
    """Put the keys of a batch into a stored set; only the folders that they fall in are read.

    Adding keys again changes nothing, so a batch may be repeated.
    """
    spark = batch.sparkSession
    span = F.expr(f"bucket div {_SPAN}")
    new = key_set(batch, key).withColumn("span", span).persist()
    try:
        spans = [r[0] for r in new.select("span").distinct().collect()]
        if not spans:
            return
        known, merged = _stored(spark, path), new.drop("span")
        if known is not None:
            merged = union_sets(known.where(F.col("span").isin(spans)).drop("span"), merged)
        tables.stage(merged.withColumn("span", span), path, ["span"])
    finally:
        new.unpersist()
    tables.swap(spark, path, ["span"])
