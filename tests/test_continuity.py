import random
from collections import Counter

import pytest

from tidemark.operators import continuity

SCHEMA = "topic string, partition int, offset bigint"


def brute(rows, first):
    """Missing ranges, ranges and repeats of each topic partition."""
    missing, ranges, again = [], [], []
    by = {}
    for topic, partition, offset in rows:
        if offset is not None:
            by.setdefault((topic, partition), Counter())[offset] += 1
    for key, seen in by.items():
        again += [(*key, o, n) for o, n in seen.items() if n > 1]
        before, run = (None if first is None else first - 1), None
        for o in sorted(seen):
            if before is not None and o - before > 1:
                missing.append((*key, before + 1, o - 1, o - before - 1))
            if run is None or o != run[1] + 1:
                if run:
                    ranges.append((*key, *run))
                run = (o, o, 0)
            run = (run[0], o, run[2] + seen[o])
            before = o
        ranges.append((*key, *run))
    return [sorted(x, key=str) for x in (missing, ranges, again)]


def found(spark, rows, first, block):
    log = spark.createDataFrame(rows, SCHEMA)
    frames = (
        continuity.missing(log, first=first, block=block),
        continuity.ranges(log, block=block),
        continuity.read_again(log),
    )
    return [sorted(map(tuple, f.collect()), key=str) for f in frames]


@pytest.mark.parametrize("block", [1, 4, 1 << 20])
@pytest.mark.parametrize("first", [None, 0])
def test_equals_one_pass_over_the_sorted_offsets(spark, block, first):
    rng = random.Random(block)
    rows = [("a", rng.randrange(2), rng.randrange(40)) for _ in range(60)]
    rows += [("b", 0, o) for o in range(3, 30)] + [("c", None, 8), ("c", None, 9), (None, 1, 12), ("a", 0, None)]
    assert found(spark, rows, first, block) == brute(rows, first)


def test_an_empty_log(spark):
    assert found(spark, [], 0, 4) == [[], [], []]
