"""The physical plans are the ones that hold at scale."""

import re
from pathlib import Path

import messages
import pyarrow.parquet as pq
import pytest
from compare import duckdb_result, spark_result
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators import capture, envelope, history, state
from tidemark.plans import marts
from tidemark.plans.queries import QUERIES
from tidemark.schemas import CUSTOMERS, OP, RAW, TS
from tidemark.sources import images, keysets, star, tables
from tidemark.streaming import jobs
from tidemark.streaming.messages import file_messages


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"\bExchange hashpartitioning", plan(df)))


@pytest.fixture
def no_broadcast(spark):
    """Joins as they are planned between large tables."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# Not the streams, which run when they are built.
STREAMS = {"bronze_compacted", "ingest_batches", "silver_skipped", "state_store"}
BATCH = [n for n in QUERIES if not n.startswith("stream_") and n not in STREAMS]


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, folder, name):
    text = plan(entry.queries()[name](spark, folder))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert bad not in text


def test_latest_per_key_limits_before_its_one_shuffle(spark, folder):
    df = state.current_state(star.user_changes(spark, folder), "user_id", seq="event_id")
    text = plan(df)
    assert exchanges(df) == 1
    assert "row_number(), 1, Partial" in text.split("Exchange hashpartitioning")[1]


def test_as_of_is_pushed_into_the_scan(spark, folder, tmp_path):
    star.user_changes(spark, folder).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    text = plan(state.current_state(log, "user_id", seq="event_id", as_of=5).select("user_id"))
    assert f"LessThanOrEqual({TS},5)" in text
    read = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {"user_id", "event_id", TS, OP}


def test_fact_shuffles_each_table_once(spark, folder, no_broadcast):
    """Orders, items and payments once each, and the keys of payments once more."""
    df = entry.queries()["fct_orders"](spark, folder)
    assert spark_result(df) == duckdb_result(entry.oracle_sql()["fct_orders"], folder)
    final = plan(df).split("== Initial Plan ==")[0]
    made = [x for x in final.split("\n") if "Exchange hashpartitioning" in x and "Reused" not in x]
    assert len(made) == 4


@pytest.mark.parametrize(
    "name",
    ["fct_orders", "scd2_history", "customer_history", "transitions", "event_order",
     "q_foreign_key", "q_reconcile", "q_transition", "q_gate"],
)
def test_building_a_query_starts_no_job(spark, folder, name):
    """Beyond reading the schemas of files, one job each."""
    context = spark.sparkContext
    context.setJobGroup(f"build-{name}", name)
    try:
        entry.queries()[name](spark, folder)
        ids = context.statusTracker().getJobIdsForGroup(f"build-{name}")
        stages = [len(context.statusTracker().getJobInfo(i).stageIds) for i in ids]
        tasks = [
            context.statusTracker().getStageInfo(s).numTasks
            for i in ids
            for s in context.statusTracker().getJobInfo(i).stageIds
        ]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert all(n == 1 for n in stages) and all(n == 1 for n in tasks)


def test_fact_reads_only_its_columns(spark, folder):
    text = plan(entry.queries()["fct_orders"](spark, folder))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double>" in text


def test_ordinary_keys_are_shuffled_once(spark, folder):
    """Hot keys go another way, and their cut points are found in a subquery of the plan."""
    log = star.user_changes(spark, folder)
    args = {"keys": "user_id", "tracked": ["value"], "ts": TS, "seq": "event_id", "compact": True}
    assert exchanges(history.scd2(log, **args, slices=None)) == 1
    ways = plan(history.scd2(log, **args)).split("\n")
    union = next(i for i, x in enumerate(ways) if re.match(r"\s*\+?-? ?Union", x.replace(":", " ")))
    text = "\n".join(ways[union:])
    ordinary = text[: text.index("\n   +- ")] if "\n   +- " in text else text
    assert len(re.findall(r"\bExchange hashpartitioning", ordinary)) == 1
    assert "Subquery" in "\n".join(ways)


def test_dimension_over_current_rows_shuffles_once(spark, folder):
    assert exchanges(entry.queries()["scd2_from_current"](spark, folder)) == 1


def test_a_message_is_parsed_once(spark, folder):
    messages = star.user_messages(star.read(spark, folder, "events"))
    rows, _ = envelope.parse_events(messages, star.USER_ROW, "users")
    assert plan(rows).count("from_json(") == 1
    assert exchanges(rows) == 0


def test_totals_are_summed_before_the_shuffle(spark, folder):
    text = plan(marts.order_totals(star.order_items(spark, folder)))
    assert "HashAggregate" in text and "SortAggregate" not in text
    assert "partial_" in text.split("Exchange")[1]


def test_silver_reads_only_good_rows_and_no_raw_messages(spark, tmp_path):
    log, mark = str(tmp_path / "log"), str(tmp_path / "mark")
    landed = str(tmp_path / "landed")
    messages.frame(spark).write.parquet(landed)
    jobs.ingest(
        file_messages(spark, landed), CUSTOMERS.row, "customers", log, mark, jobs.ALL_THERE_IS
    ).awaitTermination()
    events = jobs.read_bronze(spark, log, CUSTOMERS.row, since="2020-01-01").drop(RAW)
    text = plan(state.current_state(events, "customer_id"))
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", text).group(1)
    assert re.search(r"failed#\d+ = 0", filters)
    assert re.search(r"ingested_on#\d+ >= 2020-01-01", filters)
    assert RAW not in re.search(r"ReadSchema: (.*)", text).group(1)


def test_a_past_state_opens_no_day_before_the_kept_one(spark, folder, tmp_path):
    path, kept = str(tmp_path / "log"), str(tmp_path / "kept")
    day = F.timestamp_millis(TS).cast("date")
    log = star.user_changes(spark, folder).withColumn(jobs.DAY, day)
    log.write.partitionBy(jobs.DAY).parquet(path)
    args = {"keys": "user_id", "ts": TS, "seq": "event_id"}
    log = spark.read.parquet(path)
    for at in (1_704_672_000_000, 1_705_449_600_000):
        images.save_state(log, kept, at, jobs.DAY, **args)
    for at in (1_704_300_000_000, 1_704_672_000_000, 1_705_000_000_000, 1_706_000_000_000):
        found = images.state_as_of(log, kept, at, jobs.DAY, **args)
        full = state.current_state(log, **args, as_of=at).select(*found.columns)
        assert found.exceptAll(full).isEmpty() and full.exceptAll(found).isEmpty()
    filters = " ".join(re.findall(r"PartitionFilters: \[([^\]]*)\]", plan(found)))
    assert re.search(r"ingested_on#\d+ >= 2024-01-17", filters)


def test_only_buckets_that_differ_are_read(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    rows = spark.range(2000).selectExpr("id AS k", "id % 7 AS v")
    images.save_image(rows, old, "k", buckets=64)
    changed = F.when(F.col("k").isin(5, 6), -1).otherwise(F.col("v"))
    images.save_image(rows.where("k <> 9").withColumn("v", changed), new, "k", buckets=64)
    assert len(images.changed_buckets(spark, old, new)) <= 3
    found = images.image_diff(spark, old, new, "k", 1)
    whole = capture.snapshot_diff(rows, rows.where("k <> 9").withColumn("v", changed), "k", 1)
    assert found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty() and found.count() == 3
    assert plan(found).count("bucket_of_64#") and "PartitionFilters: [bucket_of_64#" in plan(found)
    assert images.image_diff(spark, old, old, "k", 1).isEmpty()


def test_a_new_batch_is_checked_without_the_old_rows(spark, tmp_path):
    keys, known = spark.range(100_000), str(tmp_path / "keys")
    keysets.add_keys(keys, "id", known)
    batch = spark.range(99_990, 100_010)
    text = plan(keysets.repeated_keys(batch, "id", keysets.read_set(spark, known)))
    assert "bitmap" in text and "Range (0, 100000" not in text


def test_publishing_scans_once(spark, folder, tmp_path):
    rows = star.customers(spark, folder).select("customer_id", "country")
    seen = []
    context = spark.sparkContext
    context.setJobGroup("publish", "publish")
    try:
        tables.publish(rows, str(tmp_path / "t"), {"not_null:country": F.col("country").isNull()})
        tracker = context.statusTracker()
        for job in tracker.getJobIdsForGroup("publish"):
            seen.append(len(tracker.getJobInfo(job).stageIds))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    # Two schemas, the broadcast of nations, and one write.
    assert len(seen) <= 4


def test_compacted_days_are_clustered_by_key(spark, tmp_path):
    """Fewer files, the same rows, and a key's rows in few row groups."""
    log, mark, landed = (str(tmp_path / n) for n in ("log", "mark", "landed"))
    values = {i: messages.event("c", i, messages.row(i % 500)) for i in range(2000)}
    values |= {5000 + i: "{bad" for i in range(10)}
    for part in range(3):
        some = {k: v for k, v in values.items() if k % 3 == part}
        messages.frame(spark, some).repartition(4).write.mode("append").parquet(landed)
        jobs.ingest(
            file_messages(spark, landed), CUSTOMERS.row, "customers", log, mark, jobs.ALL_THERE_IS
        ).awaitTermination()

    def rows():
        good, bad = jobs.read_bronze(spark, log, CUSTOMERS.row), jobs.read_quarantine(spark, log, CUSTOMERS.row)
        return good.collect(), bad.collect(), len({*good.inputFiles(), *bad.inputFiles()})

    before = rows()
    assert jobs.compact_log(spark, log, CUSTOMERS.row, "customer_id", before="2000-01-01") == []
    (day,) = jobs.compact_log(
        spark, log, CUSTOMERS.row, "customer_id", before="9999-01-01", file_bytes=40_000
    )
    after = rows()
    assert sorted(map(str, before[0])) == sorted(map(str, after[0])) and len(after[0]) == 2000
    assert sorted(map(str, before[1])) == sorted(map(str, after[1])) and len(after[1]) == 10
    assert after[2] < before[2]
    assert jobs.compact_log(spark, log, CUSTOMERS.row, "customer_id", before="9999-01-01") == []
    one = jobs.read_bronze(spark, log, CUSTOMERS.row).where("customer_id = 77")
    assert "EqualTo(customer_id,77)" in plan(one)
    holding = 0
    for path in Path(f"{log}/failed=0/ingested_on={day}").rglob("*.parquet"):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index("customer_id")
        for i in range(meta.num_row_groups):
            found = meta.row_group(i).column(at).statistics
            holding += found.min <= 77 <= found.max
    assert holding == 1
