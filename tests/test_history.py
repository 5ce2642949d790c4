from collections import Counter, defaultdict

import logs
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import history, skew, state
from tidemark.session import settings_for

FEW = settings(
    max_examples=4, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True
)
LOGS = st.lists(logs.LOG, min_size=5, max_size=30)


def grouped(df, columns):
    found = defaultdict(list)
    for r in df.select("case", *columns).collect():
        found[r[0]].append(tuple(r)[1:])
    return found


VERSION = ["k", "v", "valid_from_ms", "valid_to_ms", "is_current"]


@pytest.mark.parametrize("slices", [None, 2, 7])
@FEW
@given(raw=LOGS)
def test_history_with_keys_cut_anyhow(spark, slices, raw):
    cases = [logs.numbered(log) for log in raw]
    df = logs.frame(spark, [log + log[:2] for log in cases])  # some delivered twice
    for compact in (False, True):
        found = grouped(
            history.scd2(
                df, logs.KEYS, ["v"], op="op", compact=compact, slices=slices, **logs.ORDER
            ),
            VERSION,
        )
        for i, log in enumerate(cases):
            assert sorted(found[i], key=repr) == logs.intervals(log, compact)
    moves = grouped(
        history.with_previous(df, logs.KEYS, "op", slices=slices, **logs.ORDER),
        ["previous", "op"],
    )
    order = grouped(
        history.event_order(df, logs.KEYS, slices=slices, **logs.ORDER),
        ["k", "seq", "event_no"],
    )
    for i, log in enumerate(cases):
        assert Counter(moves[i]) == Counter(logs.pairs(log))
        expected = [(k, e[2], n) for k, es in logs.by_key(log).items() for n, e in enumerate(es, 1)]
        assert sorted(order[i], key=repr) == sorted(expected, key=repr)


@FEW
@given(raw=LOGS, t=st.integers(1, 6))
def test_state_as_of_is_the_history_valid_then(spark, raw, t):
    """Without undated events, whose place in time is unknown."""
    cases = [[e for e in logs.numbered(log) if e[1] is not None] for log in raw]
    df = logs.frame(spark, cases)
    versions = history.scd2(df, logs.KEYS, ["v"], op="op", **logs.ORDER)
    until = F.coalesce("valid_to_ms", F.lit(10**9))
    valid = grouped(versions.where((F.col("valid_from_ms") <= t) & (until > t)), ["k", "v"])
    past = grouped(
        state.current_state(df, logs.KEYS, op="op", as_of=t, **logs.ORDER), ["k", "v"]
    )
    for i in range(len(cases)):
        assert sorted(valid[i], key=repr) == sorted(past[i], key=repr)


@FEW
@given(raw=LOGS)
def test_intervals_of_a_key_do_not_overlap(spark, raw):
    cases = [[e for e in logs.numbered(log) if e[1] is not None] for log in raw]
    found = grouped(
        history.scd2(logs.frame(spark, cases), logs.KEYS, ["v"], op="op", slices=3, **logs.ORDER),
        VERSION,
    )
    for versions in found.values():
        for key in {v[0] for v in versions}:
            mine = sorted((v[2], v[3] if v[3] is not None else 10**9) for v in versions if v[0] == key)
            assert all(a[1] <= b[0] for a, b in zip(mine, mine[1:]))


@FEW
@given(raw=LOGS)
def test_current_versions_are_the_current_state(spark, raw):
    """Undated events too: a delete without a time ends its key."""
    cases = [logs.numbered(log) for log in raw]
    df = logs.frame(spark, cases)
    versions = history.scd2(df, logs.KEYS, ["v"], op="op", **logs.ORDER)
    found = grouped(versions.where("is_current"), ["k", "v"])
    for i, log in enumerate(cases):
        assert sorted(found[i], key=repr) == sorted(((e[0], e[4]) for e in logs.current(log)), key=repr)


def _hot_log(spark, n=60_000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 50 > 0, F.col("id") % 1000).alias("ts"),
        F.col("id").alias("seq"),
        F.lit("u").alias("op"),
        (F.col("id") % 7).cast("string").alias("v"),
    )


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_one_key_with_a_third_of_all_rows(spark):
    log = _hot_log(spark)
    args = {"keys": "k", "tracked": ["v"], "op": "op", "ts": "ts", "seq": "seq"}
    for compact in (False, True):
        whole = history.scd2(log, **args, compact=compact, slices=None)
        assert same(whole, history.scd2(log, **args, compact=compact))
    whole = history.event_order(log, "k", "ts", "seq", slices=None)
    assert same(whole, history.event_order(log, "k", "ts", "seq"))


def _tasks_of(df):
    """Rows of each task of a frame's last stage."""
    counts = df.groupBy(F.spark_partition_id().alias("task")).count().collect()
    return sorted(r["count"] for r in counts)


def test_a_burst_of_one_key_spreads_over_tasks(spark):
    """A third of all events are of one key, inside one second of a month."""
    month, tasks = 30 * 86_400_000, 16
    hot = F.col("id") % 3 == 0
    log = spark.range(90_000).select(
        F.when(hot, -1).otherwise(F.col("id") % 20_000).alias("k"),
        F.when(hot, month // 2 + F.col("id") % 1000).otherwise(F.col("id") * 31_337 % month).alias("ts"),
        F.col("id").alias("seq"),
    )
    settings = {"spark.sql.shuffle.partitions": str(tasks), "spark.sql.adaptive.enabled": "false"}
    with settings_for(spark, settings):
        found = []

        def work(rows, cuts):
            out = skew.neighbour(rows, "k", "ts", "seq", "seq", 1, "after", cuts)
            found.append(_tasks_of(out))
            return out

        every = skew.by_heat(log, "k", "ts", work)
        whole = _tasks_of(skew.neighbour(log, "k", "ts", "seq", "seq", 1, "after"))
        ordinary, cut = found
        assert whole[-1] > 4 * sum(whole) / tasks
        assert sum(cut) == 30_000 and sum(ordinary) == 60_000
        assert cut[-1] + ordinary[-1] < 2 * 90_000 / tasks
        assert every.count() == 90_000


@pytest.mark.parametrize("ts", [None, 5])
def test_events_of_one_time_are_cut_by_sequence(spark, monkeypatch, ts):
    monkeypatch.setattr(skew, "_SEQ_BLOCK", 100)
    log = _hot_log(spark, 9000).withColumn("ts", F.lit(ts).cast("bigint")).withColumn("k", F.lit(1))
    slices = []

    def work(rows, cuts):
        if cuts:
            slices.append(skew._sliced(rows, "ts", "seq", cuts).select(skew.SLICE).distinct().count())
        return rows

    skew.by_heat(log, "k", "ts", work)
    assert slices == [90]
    whole = history.event_order(log, "k", "ts", "seq", slices=None)
    assert same(whole, history.event_order(log, "k", "ts", "seq"))


def test_copies_of_one_event_collapse(spark):
    log = spark.range(3000).select(
        (F.col("id") % 3).alias("k"), F.lit(5).cast("bigint").alias("ts"), F.lit(0).alias("seq"),
        F.lit("u").alias("op"), F.lit("x").alias("v"),
    )
    for slices in (None, 10):
        versions = history.scd2(log, "k", ["v"], op="op", ts="ts", seq="seq", slices=slices)
        assert sorted(r["k"] for r in versions.collect()) == [0, 1, 2]


def test_validity_of_current_rows_is_open(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "b", None)], "k int, v string, _cdc_ts_ms bigint")
    rows = history.validity(df, "k", ["v"]).collect()
    assert sorted(map(tuple, rows)) == [(1, "a", 5, None, True), (2, "b", None, None, True)]
