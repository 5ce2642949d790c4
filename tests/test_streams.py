import messages
import pytest

from tidemark.operators import envelope, state
from tidemark.schemas import CUSTOMERS, OFFSET
from tidemark.session import scratch_dir
from tidemark.sources import buckets, tables
from tidemark.streaming import jobs
from tidemark.streaming.messages import file_messages, kafka_options

FIRST = {k: v for k, v in messages.EDGES.items() if k < 10}
REST = {k: v for k, v in messages.EDGES.items() if k >= 10}


def land(spark, path, values):
    messages.frame(spark, values).repartition(3).write.mode("append").parquet(path)


def test_a_batch_is_due_by_count_or_time():
    assert kafka_options("host:9092", ["orders", "payments"], max_offsets=10**6) == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "ecom.public.orders,ecom.public.payments",
        "startingOffsets": "earliest",
        "maxRecordsPerPartition": "1000000",
        "minOffsetsPerTrigger": "200",
        "maxTriggerDelay": "5000ms",
        "maxOffsetsPerTrigger": "1000000",
    }


def test_ingest_goes_on_where_it_stopped(spark, tmp_path):
    landed, log, mark = (str(tmp_path / p) for p in ("landed", "log", "mark"))

    def run():
        stream = file_messages(spark, landed, max_files=1)
        query = jobs.ingest(stream, CUSTOMERS.row, "customers", log, mark, jobs.ALL_THERE_IS)
        query.awaitTermination()
        counts = [p["observedMetrics"].get("customers") for p in query.recentProgress]
        return sum(c["messages"] for c in counts if c), sum(c["failed"] or 0 for c in counts if c)

    land(spark, landed, FIRST)
    assert run() == (len(messages.ROWS & set(FIRST)), 0)
    land(spark, landed, REST)
    assert run() == (len(messages.ROWS & set(REST)) + len(messages.MALFORMED), len(messages.MALFORMED))
    assert run() == (0, 0)
    found = jobs.read_bronze(spark, log, CUSTOMERS.row)
    expected, bad = envelope.parse_events(messages.frame(spark), CUSTOMERS.row, "customers")
    assert sorted(r[OFFSET] for r in found.collect()) == sorted(messages.ROWS)
    assert set(found.columns) == set(expected.columns)
    assert jobs.read_bronze(spark, log, CUSTOMERS.row, since="2000-01-01").count() == found.count()
    assert jobs.read_bronze(spark, log, CUSTOMERS.row, since="2999-01-01").isEmpty()
    broken = jobs.read_quarantine(spark, log, CUSTOMERS.row)
    assert sorted(r[OFFSET] for r in broken.collect()) == sorted(messages.MALFORMED)
    assert broken.columns == bad.columns


@pytest.mark.parametrize("job", [jobs.stream_merge, jobs.stream_current])
def test_maintained_state_equals_recompute(spark, tmp_path, job):
    landed, path, mark = (str(tmp_path / p) for p in ("landed", "state", "mark"))
    bronze, _ = envelope.parse_events(messages.frame(spark), CUSTOMERS.row, "customers")

    def run():
        stream = spark.readStream.schema(bronze.schema).option("maxFilesPerTrigger", 1).parquet(landed)
        job(
            stream, path, mark, "customer_id", trigger=jobs.ALL_THERE_IS, key_buckets=3
        ).awaitTermination()

    for part in (f"{OFFSET} >= 9", f"{OFFSET} < 9 and {OFFSET} >= 4", f"{OFFSET} < 4"):
        bronze.where(part).repartition(2).write.mode("append").parquet(landed)
        run()
    found = state.without_deletes(buckets.read_state(spark, path))
    expected = state.current_state(bronze, "customer_id")
    columns = ["customer_id", "full_name", OFFSET]
    assert {tuple(r) for r in found.select(*columns).collect()} == {
        tuple(r) for r in expected.select(*columns).collect()
    }


@pytest.mark.parametrize("step", ["overwrite_partitions", "remove"])
def test_a_batch_that_dies_while_it_swaps_is_finished(spark, tmp_path, monkeypatch, step):
    landed, path, mark = (str(tmp_path / p) for p in ("landed", "state", "mark"))
    bronze, _ = envelope.parse_events(messages.frame(spark), CUSTOMERS.row, "customers")
    bronze.write.parquet(landed)

    def run():
        stream = spark.readStream.schema(bronze.schema).parquet(landed)
        jobs.stream_merge(
            stream, path, mark, "customer_id", trigger=jobs.ALL_THERE_IS
        ).awaitTermination()

    def broken(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(tables, step, broken)
        with pytest.raises(Exception, match="lost"):
            run()
    assert tables.exists(spark, f"{path}-staged/_SUCCESS")
    expected = state.current_state(bronze, "customer_id")
    columns = ["customer_id", "full_name", OFFSET]
    want = sorted(map(tuple, expected.select(*columns).collect()), key=str)
    for again in (False, True):
        if again:
            run()
        found = state.without_deletes(buckets.read_state(spark, path))
        assert sorted(map(tuple, found.select(*columns).collect()), key=str) == want
    assert not tables.exists(spark, f"{path}-staged")


def test_a_repeated_batch_of_the_log_overwrites_itself(spark, tmp_path, monkeypatch):
    landed, log, mark = (str(tmp_path / p) for p in ("landed", "log", "mark"))
    land(spark, landed, FIRST)

    def run():
        stream = file_messages(spark, landed)
        jobs.ingest(stream, CUSTOMERS.row, "customers", log, mark, jobs.ALL_THERE_IS).awaitTermination()

    write = tables.overwrite_partitions

    def written_then_lost(*args):
        write(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(tables, "overwrite_partitions", written_then_lost)
        with pytest.raises(Exception, match="lost"):
            run()
    run()
    assert jobs.read_bronze(spark, log, CUSTOMERS.row).count() == len(messages.ROWS & set(FIRST))


def test_a_compaction_that_dies_is_finished_and_late_batches_stay(spark, tmp_path, monkeypatch):
    landed, log, mark = (str(tmp_path / p) for p in ("landed", "log", "mark"))
    n = len(messages.ROWS)

    def take(values):
        land(spark, landed, values)
        stream = file_messages(spark, landed)
        jobs.ingest(stream, CUSTOMERS.row, "customers", log, mark, jobs.ALL_THERE_IS).awaitTermination()

    def compact():
        return jobs.compact_log(spark, log, CUSTOMERS.row, "customer_id", before="9999-01-01")

    def broken(*args):
        raise RuntimeError("lost")

    take(FIRST)
    for step in ("overwrite_partitions", "remove"):
        with monkeypatch.context() as m:
            m.setattr(tables, step, broken)
            with pytest.raises(RuntimeError, match="lost"):
                compact()
    compact()
    assert jobs.read_bronze(spark, log, CUSTOMERS.row).count() == len(messages.ROWS & set(FIRST))
    take(REST)
    assert jobs.read_bronze(spark, log, CUSTOMERS.row).count() == n
    jobs._finish_compaction(spark, log)
    assert jobs.read_bronze(spark, log, CUSTOMERS.row).count() == n
    assert len(compact()) == 1 and compact() == []
    assert jobs.read_bronze(spark, log, CUSTOMERS.row).count() == n


def test_compaction_sorts_a_bounded_share_of_a_day_in_a_task(spark, tmp_path, monkeypatch):
    """Neither malformed messages nor events of one key and time end up in one task."""
    landed, log, mark = (str(tmp_path / p) for p in ("landed", "log", "mark"))
    values = {i: messages.event("c", 5, messages.row(1)) for i in range(400)}
    values |= {1000 + i: "{bad" for i in range(400)}
    messages.frame(spark, values).write.parquet(landed)
    stream = file_messages(spark, landed)
    jobs.ingest(stream, CUSTOMERS.row, "customers", log, mark, jobs.ALL_THERE_IS).awaitTermination()
    monkeypatch.setattr(jobs, "SORT_BYTES", tables.size(spark, log) // 7, raising=False)
    assert jobs.compact_log(spark, log, CUSTOMERS.row, "customer_id", before="9999-01-01")
    for failed, read in ((0, jobs.read_bronze), (1, jobs.read_quarantine)):
        sizes = [
            spark.read.parquet(f).count()
            for f in read(spark, log, CUSTOMERS.row).inputFiles()
            if f"failed={failed}" in f
        ]
        assert sum(sizes) == 400 and max(sizes) <= 200


def test_scratch_is_the_shared_folder_of_the_session(spark, shared):
    first = scratch_dir(spark, "x")
    assert first.startswith(f"{shared}/x-") and first != scratch_dir(spark, "x")
