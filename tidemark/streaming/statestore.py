"""The state of a streaming aggregate, read from its checkpoint and held against its log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import names, position
from tidemark.operators.state import latest_per_key
from tidemark.schemas import SEQ, TS


def kept_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Keys and newest rows that ``stream_current`` keeps, as of its last finished batch.

    The aggregate's buffer holds the row and its place in the key's order: the columns of the
    key, ``row`` and ``place``. Nothing is restarted, and the stream's own files are only read.
    """
    found = spark.read.format("statestore").load(checkpoint)
    row, place = found.schema["value"].dataType.names[:2]
    return found.select("key.*", F.col(f"value.{row}").alias("row"), F.col(f"value.{place}").alias("place"))


def compare(
    kept: DataFrame,
    log: DataFrame,
    keys: str | Sequence[str],
    ts: str = TS,
    seq: str | Sequence[str] = SEQ,
) -> DataFrame:
    """One row: keys kept, keys of the log, and on how many the newest event differs."""
    keys = names(keys)
    key = F.struct(*[F.col(k) for k in keys]).alias("_key")
    newest = latest_per_key(log, keys, ts, seq).select(key, position(ts, seq).alias("_log"))
    held = kept.select(key, F.col("place").alias("_kept"))
    both = newest.join(held, "_key", "full")
    return both.agg(
        F.count("_kept").alias("keys_kept"),
        F.count("_log").alias("keys_in_log"),
        F.count_if(~F.col("_kept").eqNullSafe(F.col("_log"))).alias("differ"),
    )
