import random

from tidemark.operators import capture, envelope, state
from tidemark.schemas import row_schema
from pyspark.sql import functions as F

SCHEMA = row_schema("k bigint, a string, b double")


def random_table(rnd):
    keys = rnd.sample(range(20), rnd.randint(0, 15))
    return {k: (k, rnd.choice(["x", "y", None]), rnd.choice([1.5, 2.5, None])) for k in keys}


def test_diff_turns_old_into_new(spark):
    for seed in range(3):
        rnd = random.Random(seed)
        old, new = random_table(rnd), random_table(rnd)
        before = spark.createDataFrame(list(old.values()), SCHEMA)
        after = spark.createDataFrame(list(new.values()), SCHEMA)
        events = capture.snapshot_diff(before, after, "k", 9)
        ops = {}
        for e in events.collect():
            ops[(e["after"] or e["before"])["k"]] = e["op"]
            assert e["ts_ms"] == 9
            assert e["before"] == old.get((e["after"] or e["before"])["k"])
            assert e["after"] == new.get((e["after"] or e["before"])["k"])
        expected = {k: "c" for k in new.keys() - old.keys()}
        expected |= {k: "d" for k in old.keys() - new.keys()}
        expected |= {k: "u" for k in old.keys() & new.keys() if old[k] != new[k]}
        assert ops == expected

        log = capture.to_envelopes(capture.snapshot_events(before, 1), "t", F.lit(0)).unionByName(
            capture.to_envelopes(events, "t", F.lit(1))
        )
        bronze, bad = envelope.parse_events(log, SCHEMA, "t")
        current = state.current_state(bronze, "k")
        assert bad.isEmpty()
        assert {r["k"]: tuple(r)[:3] for r in current.collect()} == new


def test_nothing_changed(spark):
    table = spark.createDataFrame([(1, None, None), (2, "x", 0.5)], SCHEMA)
    assert capture.snapshot_diff(table, table, "k", 1).isEmpty()
