"""Message streams: topic, partition, offset, value."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import TOPIC_PREFIX, row_schema

MESSAGE = row_schema("topic string, partition int, offset bigint, value binary")

# A batch is due at this many messages, or after this time.
BATCH_MESSAGES = 200
BATCH_DELAY = "5000ms"

# Most messages of one topic partition in one task; a hot partition is read by several.
TASK_MESSAGES = 1_000_000


def kafka_options(
    servers: str,
    tables: Iterable[str],
    prefix: str = TOPIC_PREFIX,
    min_offsets: int | None = BATCH_MESSAGES,
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Options to read the change topics of ``tables`` from the earliest offset on.

    A micro-batch waits for ``min_offsets`` messages or five seconds, whichever is first,
    and takes ``max_offsets`` at most.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(prefix + t for t in tables),
        "startingOffsets": "earliest",
        "maxRecordsPerPartition": str(TASK_MESSAGES),
    }
    if min_offsets:
        options |= {"minOffsetsPerTrigger": str(min_offsets), "maxTriggerDelay": BATCH_DELAY}
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_messages(
    spark: SparkSession, servers: str, tables: Iterable[str], **options
) -> DataFrame:
    """The change topics of ``tables`` as a stream; see ``kafka_options``.

    A checkpoint takes the place of a consumer group: a restarted query goes on where the
    last finished batch ended. Needs the Kafka connector on the class path.
    """
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, tables, **options))
    return reader.load().select("topic", "partition", "offset", "value")


def file_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Messages landed as Parquet files, read as a stream."""
    reader = spark.readStream.schema(MESSAGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
