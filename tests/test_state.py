import random
from collections import defaultdict

import logs
import messages
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import envelope, sampling, state
from tidemark.schemas import CUSTOMERS, SEQ, TS

FEW = settings(
    max_examples=6, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True
)


def per_case(rows):
    found = defaultdict(list)
    for r in rows:
        found[r[0]].append(tuple(r)[1:])
    return found


def events_of(df):
    return per_case(df.select(*logs.SCHEMA.fieldNames()).collect())


def bronze(spark, offsets=None):
    values = {k: v for k, v in messages.EDGES.items() if offsets is None or k in offsets}
    return envelope.parse_events(messages.frame(spark, values), CUSTOMERS.row, "customers")[0]


def names_of(df):
    return {r["customer_id"]: r["full_name"] for r in df.collect()}


CURRENT = {
    None: None,
    1: "tie won",
    3: "undated",
    4: "no op",
    6: "extra",
    9: 'the "payload" of a plain event',
}


def test_edges(spark):
    current = state.current_state(bronze(spark), "customer_id")
    assert names_of(current) == CURRENT


def test_edges_merged_in_any_split(spark):
    for first in ({0, 1, 5, 9}, {5, 7, 16}, set(range(0, 27, 2)) | {31}):
        rest = set(messages.EDGES) - first
        merged = state.merge_changes(bronze(spark, first), bronze(spark, rest), "customer_id")
        assert names_of(state.without_deletes(merged)) == CURRENT


def test_deleted_and_audit(spark):
    events = bronze(spark)
    deleted = state.deleted_keys(events, "customer_id").collect()
    assert [tuple(r) for r in deleted] == [(2,)]
    (row,) = state.audit(events, "customer_id").collect()
    assert tuple(row) == (len(messages.ROWS), 6, 1)


def test_audit_of_nothing(spark):
    (row,) = state.audit(bronze(spark, {6}), "customer_id").collect()
    assert tuple(row) == (0, 0, 0)


@FEW
@given(st.lists(logs.LOG, min_size=5, max_size=30), st.integers(1, 6))
def test_current_and_as_of(spark, raw, as_of):
    cases = [logs.numbered(log) for log in raw]
    df = logs.frame(spark, cases)
    now = events_of(state.current_state(df, logs.KEYS, op="op", **logs.ORDER))
    past = events_of(state.current_state(df, logs.KEYS, op="op", as_of=as_of, **logs.ORDER))
    for i, log in enumerate(cases):
        assert sorted(now[i], key=repr) == sorted(logs.current(log), key=repr)
        assert sorted(past[i], key=repr) == sorted(logs.current(log, as_of), key=repr)


@FEW
@given(st.lists(logs.LOG, min_size=5, max_size=30), st.integers(0, 10**6))
def test_merge_of_any_split_order_and_copies(spark, raw, seed):
    rnd = random.Random(seed)
    cases = [logs.numbered(log) for log in raw]
    parts = [[], [], []]
    for log in cases:
        shuffled = rnd.sample(log, len(log)) + rnd.choices(log, k=3 if log else 0)
        for p in parts:
            p.append([])
        for e in shuffled:
            rnd.choice(parts)[-1].append(e)
    merged = logs.frame(spark, parts[0])
    for p in parts[1:]:
        merged = state.merge_changes(merged, logs.frame(spark, p), logs.KEYS, **logs.ORDER)
    found = events_of(state.without_deletes(merged, "op"))
    for i, log in enumerate(cases):
        assert sorted(found[i], key=repr) == sorted(logs.current(log), key=repr)


def test_new_columns_survive_a_merge(spark):
    old = spark.createDataFrame([(1, 5, 0, "a")], f"k int, {TS} bigint, seq int, v string")
    new = spark.createDataFrame(
        [(1, 4, 1, "b", "p"), (2, 4, 2, "b", "p")], f"k int, {TS} bigint, seq int, v string, w string"
    )
    rows = state.merge_changes(old, new, "k", seq="seq").collect()
    assert {(r["k"], r["v"], r["w"]) for r in rows} == {(1, "a", None), (2, "b", "p")}


def test_samples_are_fixed_and_differ_by_seed(spark):
    df = spark.range(1000).repartition(7)
    one = sampling.sample_rows(df, "id", 20, seed=1).collect()
    again = sampling.sample_rows(df.repartition(3), "id", 20, seed=1).collect()
    other = sampling.sample_rows(df, "id", 20, seed=2).collect()
    assert one == again and len(set(one)) == 20 and one != other
    assert [r["id"] for r in sampling.preview(df, "id", 3).collect()] == [0, 1, 2]


def test_default_sequence_is_partition_and_offset():
    assert SEQ == ("_partition", "_offset")
