"""Streaming jobs: messages to bronze, and bronze to a maintained current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import names, position
from tidemark.operators import envelope
from tidemark.schemas import (
    INGESTED,
    OFFSET,
    OP,
    PARTITION,
    RAW,
    SEQ,
    SOURCE,
    TOPIC_PREFIX,
    TS,
)
from tidemark.session import settings_for
from tidemark.sources import buckets, tables

# Partition columns of the log: whether a message failed to decode, the day it came, and the
# micro-batch that brought it. A negative batch -n - 1 stands for all of the day's batches up to n.
FAILED = "failed"
DAY = "ingested_on"
BATCH = "batch"
LOG_PARTITIONS = [FAILED, DAY, BATCH]

# Stored bytes of a log that one task sorts: its rows take about ten times as many in memory.
SORT_BYTES = 32 * 1024 * 1024

# A micro-batch every five seconds, or all there is and then stop.
EVERY_5_SECONDS = {"processingTime": "5 seconds"}
ALL_THERE_IS = {"availableNow": True}


def ingest(
    messages: DataFrame,
    row_schema: T.StructType,
    table: str,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    prefix: str = TOPIC_PREFIX,
) -> StreamingQuery:
    """Append the bronze rows of one table to ``path``; malformed messages go there too.

    The log is partitioned by whether a message failed to decode, by day and by micro-batch,
    so one pass writes all and a reader opens only what it wants. The day is the batch's own,
    kept in the checkpoint: a batch that is repeated overwrites exactly its own folders, so
    each message is there once. The progress of each batch reports rows and failures.
    """
    rows = envelope.decode(messages, row_schema, table, prefix)

    def write(batch: DataFrame, number: int) -> None:
        tables.overwrite_partitions(batch.withColumn(BATCH, F.lit(number)), path, LOG_PARTITIONS)

    return (
        rows.withColumn(FAILED, F.col(envelope.ERROR).isNotNull().cast("int"))
        .withColumn(DAY, F.current_date())
        .observe(table, F.count(F.lit(1)).alias("messages"), F.sum(FAILED).alias("failed"))
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_5_SECONDS))
        .start()
    )


def bronze_schema(row_schema: T.StructType) -> T.StructType:
    """Columns of the log that ``ingest`` writes, known without opening its files."""
    return T.StructType(
        [
            *row_schema.fields,
            *[T.StructField(c, T.StringType()) for c in (OP, SOURCE, INGESTED)],
            *[T.StructField(c, T.LongType()) for c in (TS, OFFSET)],
            T.StructField(PARTITION, T.IntegerType()),
            T.StructField(RAW, T.BinaryType()),
            T.StructField(envelope.ERROR, T.StringType()),
            T.StructField(FAILED, T.IntegerType()),
            T.StructField(DAY, T.DateType()),
            T.StructField(BATCH, T.LongType()),
        ]
    )


def read_bronze(
    spark: SparkSession, path: str, row_schema: T.StructType, since: str | None = None
) -> DataFrame:
    """The event log that ``ingest`` writes, without the malformed messages.

    Columns that the row schema has gained since a file was written read as null.
    ``since`` (a date) leaves out the folders of earlier days.
    """
    log = spark.read.schema(bronze_schema(row_schema)).parquet(path)
    return _rows(log.where(F.col(DAY) >= F.lit(since).cast("date")) if since else log)


def follow_bronze(spark: SparkSession, path: str, row_schema: T.StructType) -> DataFrame:
    """The same log as a stream."""
    return _rows(spark.readStream.schema(bronze_schema(row_schema)).parquet(path))


def _rows(log: DataFrame) -> DataFrame:
    return log.where(F.col(FAILED) == 0).drop(*LOG_PARTITIONS, envelope.ERROR)


def read_quarantine(spark: SparkSession, path: str, row_schema: T.StructType) -> DataFrame:
    """The malformed messages that ``ingest`` set aside, with the reason."""
    log = spark.read.schema(bronze_schema(row_schema)).parquet(path)
    return log.where(F.col(FAILED) == 1).select(
        SOURCE, PARTITION, OFFSET, INGESTED, RAW, envelope.ERROR
    )


def ingested_batches(spark: SparkSession, path: str, row_schema: T.StructType) -> DataFrame:
    """Per micro-batch of the log: batch, messages and how many of them are malformed."""
    log = spark.read.schema(bronze_schema(row_schema)).parquet(path)
    return log.groupBy(BATCH).agg(F.count(F.lit(1)).alias("messages"), F.sum(FAILED).alias("failed"))


def compact_log(
    spark: SparkSession,
    path: str,
    row_schema: T.StructType,
    keys: str | Sequence[str],
    before: str | None = None,
    file_bytes: int = 512 * 1024 * 1024,
) -> list[str]:
    """Rewrite the closed days of a log to few files; returns those days.

    Days before ``before`` (by default today) that have new batches, malformed messages
    included, become one batch folder each, dealt by ranges of (key, time, place in the topic),
    so a reader of some keys skips row groups. A range is a file of about ``file_bytes``, or of
    what one task sorts (SORT_BYTES) if that is less. Rows stay as they are. The rewritten days are staged, then swapped
    in by partition overwrite, then the batch folders they stand for go; each step can be
    repeated, and a run that died half-way is finished by the next one. In between a reader may
    see rows of a day twice, as it does after a repeated delivery. Batches that come later for
    such a day stay beside it until the next run. A stream that follows the log reads rewritten days
    again, which changes no state.
    """
    keys = names(keys)
    _finish_compaction(spark, path)
    limit = before or spark.sql("SELECT CAST(current_date() AS STRING)").first()[0]
    found = [f for f in _batch_folders(spark, path) if f[1] < limit]
    days = sorted({day for _, day, batch in found if batch >= 0})
    if not days:
        return days
    found = [f for f in found if f[1] in days]
    newest = max(batch for _, _, batch in found)
    sizes = [tables.size(spark, _batch_folder(path, *f)) for f in found]
    # Malformed messages have neither key nor time: their place in the topic tells them apart.
    place = [FAILED, DAY, *keys, TS, PARTITION, OFFSET]
    log = spark.read.schema(bronze_schema(row_schema)).parquet(path)
    rows = log.where(F.col(DAY).isin([F.lit(d).cast("date") for d in days]))
    dealt = rows.withColumn(BATCH, F.lit(-newest - 1)).repartitionByRange(
        int(sum(sizes) // min(file_bytes, SORT_BYTES) + 1), *place
    )
    tables.stage(dealt.sortWithinPartitions(*place), path, LOG_PARTITIONS)
    _finish_compaction(spark, path)
    return days


def _batch_folder(path: str, failed: str, day: str, batch: int) -> str:
    return f"{path}/{FAILED}={failed}/{DAY}={day}/{BATCH}={batch}"


def _batch_folders(spark: SparkSession, path: str) -> list[tuple[str, str, int]]:
    """(failed, day, batch) of the folders of a log."""
    return [
        (failed.partition("=")[2], day.partition("=")[2], int(batch.partition("=")[2]))
        for failed in tables.folders(spark, path)
        for day in tables.folders(spark, f"{path}/{failed}")
        for batch in tables.folders(spark, f"{path}/{failed}/{day}")
    ]


def _finish_compaction(spark: SparkSession, path: str) -> None:
    """Swap in what is staged completely, and drop the batch folders that it stands for."""
    # Each staged file is read by a task of its own, so it stays one range of keys.
    with settings_for(spark, {"spark.sql.files.openCostInBytes": str(1 << 30)}):
        tables.swap(spark, path, LOG_PARTITIONS)
    found = _batch_folders(spark, path)
    for failed, day in {f[:2] for f in found}:
        batches = [b for f, d, b in found if (f, d) == (failed, day)]
        whole = min(batches)
        for batch in batches:
            if whole < batch < -whole:
                tables.remove(spark, _batch_folder(path, failed, day, batch))


def stream_merge(
    events: DataFrame,
    path: str,
    checkpoint: str,
    keys: str | Sequence[str],
    ts: str = TS,
    seq: str | Sequence[str] = SEQ,
    trigger: dict | None = None,
    key_buckets: int = buckets.BUCKETS,
) -> StreamingQuery:
    """Merge each micro-batch of ``events`` into the state table at ``path``.

    A batch rewrites the key buckets that it touches, see ``buckets.upsert``; read with
    ``buckets.read_state``. A batch that is repeated after a failure changes nothing.
    """
    keys = names(keys)

    def merge(batch: DataFrame, _: int) -> None:
        buckets.upsert(batch, path, keys, ts, seq, key_buckets)

    return (
        events.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_5_SECONDS))
        .start()
    )


def current_by_key(
    events: DataFrame, keys: str | Sequence[str], ts: str = TS, seq: str | Sequence[str] = SEQ
) -> DataFrame:
    """The newest event per key as a streaming aggregate, deletes included.

    One state row per key, kept for good: a current row does not expire.
    """
    keys = names(keys)
    rest = [c for c in events.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), position(ts, seq)).alias("_row")
    return events.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*events.columns)


def stream_current(
    events: DataFrame,
    path: str,
    checkpoint: str,
    keys: str | Sequence[str],
    ts: str = TS,
    seq: str | Sequence[str] = SEQ,
    trigger: dict | None = None,
    key_buckets: int = buckets.BUCKETS,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Keep the newest event per key in the state store and publish each key that changes.

    The state store is RocksDB, so it need not fit in executor memory. Only keys seen in a
    batch are written; read the table with ``buckets.read_state``. ``state_partitions``, by
    default the session's shuffle partitions, stays as the first run sets it.
    """
    keys = names(keys)
    settings = {
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        )
    }
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)

    def publish(changed: DataFrame, _: int) -> None:
        buckets.upsert(changed, path, keys, ts, seq, key_buckets)

    # A query keeps the settings it was started with.
    with settings_for(events.sparkSession, settings):
        return (
            current_by_key(events, keys, ts, seq)
            .writeStream.outputMode("update")
            .foreachBatch(publish)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or EVERY_5_SECONDS))
            .start()
        )
