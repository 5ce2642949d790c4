"""Topic messages decoded into bronze rows, with malformed ones set aside.

A message value is JSON: an event ``{op, ts_ms, before, after}``, or the same under a
``payload`` key. A null value is a tombstone and an event without an image (a truncate)
has no row; both are dropped. A value that cannot be read as an event of the declared row
schema is kept whole, with the reason, instead of stopping the stream.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import utc_iso
from tidemark.operators.capture import row_image
from tidemark.schemas import (
    INGESTED,
    OFFSET,
    OP,
    PARTITION,
    RAW,
    SOURCE,
    TOPIC_PREFIX,
    TS,
)

ERROR = "_error"
_CORRUPT = "_corrupt"


def message_schema(row_schema: T.StructType) -> T.StructType:
    """The wrapped and the plain event shape in one schema, as the items of a list.

    ``decode`` puts each value into a list before it parses it: a parser that has read one
    object does not look at what follows, but in a list anything else is an error.
    """
    event = [
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("before", row_schema),
        T.StructField("after", row_schema),
    ]
    message = T.StructType([T.StructField("payload", T.StructType(event)), *event])
    return T.StructType(
        [
            T.StructField("list", T.ArrayType(message)),
            T.StructField(_CORRUPT, T.StringType()),
        ]
    )


def decode(
    messages: DataFrame,
    row_schema: T.StructType,
    tables: str | Iterable[str],
    prefix: str = TOPIC_PREFIX,
) -> DataFrame:
    """Bronze rows of the messages of ``tables``, plus ``_error`` for malformed values.

    Malformed messages have null row columns and a reason in ``_error``. One pass, no
    shuffle, the same for batch and stream. ``messages`` has topic, partition, offset and
    value.
    """
    tables = [tables] if isinstance(tables, str) else list(tables)
    topics = [prefix + t for t in tables]
    schema = message_schema(row_schema)
    text = F.col("value").cast("string")
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _CORRUPT,
        "allowSingleQuotes": "false",
    }
    in_list = F.concat(F.lit('{"list":['), F.col("_text"), F.lit("]}"))
    # A value whose payload is JSON null looks like a plain event without fields.
    null_payload = (F.instr("_text", '"payload"') > 0) & F.array_contains(
        F.json_object_keys("_text"), "payload"
    )
    wrapped = F.col("_e.payload").isNotNull()
    return (
        messages.where(F.col("topic").isin(topics) & F.col("value").isNotNull())
        .select("topic", "partition", "offset", F.try_validate_utf8(text).alias("_text"), "value")
        .select(
            "topic", "partition", "offset", "_text", "value",
            # A one-element explode: the filters below are then not pushed under the
            # parse, where each use of a field would parse the value again.
            F.explode(F.array(F.from_json(in_list, schema, options))).alias("_parsed"),
        )
        .select("*", F.get("_parsed.list", F.lit(0)).alias("_e"))
        .select(
            "topic", "partition", "offset", "value",
            F.when(F.col("_text").isNull(), "value is not UTF-8")
            .when(F.col(f"_parsed.{_CORRUPT}").isNotNull(), "value does not fit the row schema")
            .when(F.col("_e").isNull() | (F.size("_parsed.list") != 1), "value is not one JSON object")
            .when(~wrapped & null_payload, "payload is null")
            .alias(ERROR),
            *[
                F.when(wrapped, F.col(f"_e.payload.{c}")).otherwise(F.col(f"_e.{c}")).alias(c)
                for c in ("op", "ts_ms", "before", "after")
            ],
        )
        .withColumn("_row", F.when(F.col(ERROR).isNull(), row_image()))
        .where(F.col("_row").isNotNull() | F.col(ERROR).isNotNull())
        .select(
            *[F.col(f"_row.{c}").alias(c) for c in row_schema.fieldNames()],
            F.when(F.col(ERROR).isNull(), F.col("op")).alias(OP),
            F.when(F.col(ERROR).isNull(), F.col("ts_ms")).alias(TS),
            F.replace("topic", F.lit(prefix), F.lit("")).alias(SOURCE),
            utc_iso(F.current_timestamp()).alias(INGESTED),
            F.col("partition").alias(PARTITION),
            F.col("offset").alias(OFFSET),
            F.col("value").alias(RAW),
            ERROR,
        )
    )


def parse_events(
    messages: DataFrame,
    row_schema: T.StructType,
    tables: str | Iterable[str],
    prefix: str = TOPIC_PREFIX,
) -> tuple[DataFrame, DataFrame]:
    """(bronze rows, quarantined messages with a reason)."""
    return split_errors(decode(messages, row_schema, tables, prefix))


def split_errors(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decoded messages as (bronze rows, quarantined messages with a reason)."""
    bronze = decoded.where(F.col(ERROR).isNull()).drop(ERROR)
    malformed = decoded.where(F.col(ERROR).isNotNull()).select(
        SOURCE, PARTITION, OFFSET, INGESTED, RAW, ERROR
    )
    return bronze, malformed


def reparse(
    bronze: DataFrame,
    row_schema: T.StructType,
    tables: str | Iterable[str],
    prefix: str = TOPIC_PREFIX,
) -> DataFrame:
    """Bronze rows, or quarantined messages, read again under a newer row schema."""
    messages = bronze.select(
        F.concat(F.lit(prefix), F.col(SOURCE)).alias("topic"),
        F.col(PARTITION).alias("partition"),
        F.col(OFFSET).alias("offset"),
        F.col(RAW).alias("value"),
    )
    return parse_events(messages, row_schema, tables, prefix)[0]


def observed_columns(bronze: DataFrame) -> DataFrame:
    """Per table, every column name seen in the raw row images, with its event count."""
    fields = T.MapType(T.StringType(), T.StringType())
    images = [T.StructField("after", fields), T.StructField("before", fields)]
    shape = T.StructType([T.StructField("payload", T.StructType(images)), *images])
    image = F.coalesce("_m.payload.after", "_m.after", "_m.payload.before", "_m.before")
    return (
        bronze.select(SOURCE, F.from_json(F.col(RAW).cast("string"), shape).alias("_m"))
        .select(SOURCE, F.explode(F.map_keys(image)).alias("column_name"))
        .groupBy(SOURCE, "column_name")
        .agg(F.count(F.lit(1)).alias("events"))
    )


def observed_schema(bronze: DataFrame) -> DataFrame:
    """Per table, the schema of all raw messages as inferred by a distributed aggregate."""
    value = F.try_parse_json(F.col(RAW).cast("string"))
    return bronze.groupBy(SOURCE).agg(F.schema_of_variant_agg(value).alias("message_schema"))
