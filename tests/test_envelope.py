import json

import messages
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import capture, envelope
from tidemark.schemas import CUSTOMERS, INGESTED, OFFSET, OP, RAW, SOURCE, TS, row_schema


@pytest.fixture(scope="module")
def parsed(spark):
    bronze, bad = envelope.parse_events(messages.frame(spark), CUSTOMERS.row, "customers")
    return {r[OFFSET]: r for r in bronze.collect()}, {r[OFFSET]: r for r in bad.collect()}


def test_each_message_is_a_row_or_quarantined_or_dropped(parsed):
    rows, bad = parsed
    assert set(rows) == messages.ROWS
    assert set(bad) == messages.MALFORMED


def test_row_columns_and_metadata(parsed):
    rows, _ = parsed
    first = rows[0]
    assert (first["customer_id"], first["full_name"], first[OP], first[TS]) == (1, "first", "r", 5)
    assert first[SOURCE] == "customers"
    assert json.loads(bytes(first[RAW]))["payload"]["op"] == "r"
    assert len(first[INGESTED]) == len("2024-01-01T00:00:00.000000")


def test_delete_takes_the_old_image(parsed):
    rows, _ = parsed
    assert (rows[5][OP], rows[5]["full_name"]) == ("d", "two")


def test_empty_image_counts_as_present(parsed):
    rows, _ = parsed
    assert rows[14]["customer_id"] is None


def test_reasons(parsed):
    _, bad = parsed
    reasons = {offset: r[envelope.ERROR] for offset, r in bad.items()}
    assert reasons[13] == reasons[22] == "payload is null"
    assert reasons[21] == "value is not UTF-8"
    assert bytes(bad[12][RAW]) == b"{bad"
    assert reasons[17] == reasons[18] == reasons[29] == "value is not one JSON object"
    assert reasons[25] == "value does not fit the row schema"


def test_other_topics_are_not_read(spark):
    frame = messages.frame(spark, topic="ecom.public.payments")
    bronze, bad = envelope.parse_events(frame, CUSTOMERS.row, "customers")
    assert bronze.isEmpty() and bad.isEmpty()


def test_new_column_comes_from_the_raw_message(spark):
    bronze, _ = envelope.parse_events(messages.frame(spark), CUSTOMERS.row, "customers")
    seen = {r["column_name"]: r["events"] for r in envelope.observed_columns(bronze).collect()}
    assert seen["phone"] == 1
    wider = T.StructType([*CUSTOMERS.row.fields, T.StructField("phone", T.StringType())])
    again = envelope.reparse(bronze, wider, "customers")
    assert {r[OFFSET]: r["phone"] for r in again.collect() if r["phone"]} == {15: "123"}


def test_quarantined_messages_can_be_read_under_another_schema(spark):
    _, bad = envelope.parse_events(messages.frame(spark), CUSTOMERS.row, "customers")
    fields = [
        T.StructField(f.name, T.StringType()) if f.name == "signup_date" else f
        for f in CUSTOMERS.row.fields
    ]
    again = envelope.reparse(bad, T.StructType(fields), "customers")
    assert [(r[OFFSET], r["signup_date"]) for r in again.collect()] == [(25, "soon")]


def test_observed_schema_names_every_field(spark):
    bronze, _ = envelope.parse_events(messages.frame(spark), CUSTOMERS.row, "customers")
    (found,) = envelope.observed_schema(bronze).collect()
    assert "phone" in found["message_schema"] and found[SOURCE] == "customers"


def test_envelopes_round_trip(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, None, 0.1)], "k long, s string, v double")
    events = capture.snapshot_events(rows, 7)
    schema = row_schema("k bigint, s string, v double")
    for wrapped in (True, False):
        sent = capture.to_envelopes(events, "t", F.lit(0), wrapped)
        bronze, bad = envelope.parse_events(sent, schema, "t")
        assert bad.isEmpty()
        assert sorted(bronze.select("k", "s", "v", OP, TS).collect()) == [
            (1, "a", None, "r", 7),
            (2, None, 0.1, "r", 7),
        ]
