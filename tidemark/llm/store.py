"""Stored intermediate tables and filters of a fixed size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_dir, settings_for

#: Rows that Python workers get at once: by bytes, so long texts come a few at a time.
ARROW = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 20),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
}

#: Buckets of a key filter: at most this many 8-byte rows are ever broadcast.
FILTER_BUCKETS = 1 << 20


def bounded(df: DataFrame) -> DataFrame:
    """``df``, whose session gives Python workers a bounded number of bytes at once from now on.

    For results that the caller writes: Spark looks at the setting when a job is planned.
    """
    for name, value in ARROW.items():
        df.sparkSession.conf.set(name, value)
    return df


def stored(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage.

    The folder is the one that ``spark.checkpoint.dir`` names, so the table outlives any
    executor.
    """
    path = scratch_dir(df.sparkSession, label)
    with settings_for(df.sparkSession, ARROW):
        df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucket(*cols: str | Column) -> Column:
    """The filter bucket of a key."""
    return F.pmod(F.xxhash64(*cols), F.lit(FILTER_BUCKETS))


def maybe_in(df: DataFrame, keys: DataFrame, cols: list[str], keep: bool = True) -> DataFrame:
    """Rows of ``df`` whose key may be among ``keys`` (or, with ``keep=False``, surely is not).

    Only the distinct buckets of the keys are broadcast: FILTER_BUCKETS rows at most, however
    many keys there are. A row of another key can pass by sharing a bucket, so callers
    follow with an exact step; the filter just keeps most rows out of the shuffle there.
    """
    buckets = keys.select(bucket(*cols).alias("_bucket")).distinct()
    marked = df.withColumn("_bucket", bucket(*cols))
    how = "left_semi" if keep else "left_anti"
    return marked.join(F.broadcast(buckets), "_bucket", how).drop("_bucket")
