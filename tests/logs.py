"""Small event logs and what they mean, worked out in plain Python."""

from __future__ import annotations

from hypothesis import strategies as st

from tidemark.schemas import row_schema

SCHEMA = row_schema("case bigint, k bigint, ts bigint, seq bigint, op string, v string")
KEYS = ["case", "k"]
ORDER = {"ts": "ts", "seq": "seq"}

EVENT = st.tuples(
    st.sampled_from([None, 1, 2, 3]),
    st.sampled_from([None, 1, 2, 3, 4, 5, 6]),
    st.sampled_from(["c", "u", "u", "d", "r", None]),
    st.sampled_from(["x", "y", None]),
)
LOG = st.lists(EVENT, max_size=25)


def numbered(log):
    """(k, ts, seq, op, v) rows; the sequence is the place in the list."""
    return [(k, ts, seq, op, v) for seq, (k, ts, op, v) in enumerate(log)]


def frame(spark, logs):
    rows = [(case, *e) for case, log in enumerate(logs) for e in log]
    return spark.createDataFrame(rows, SCHEMA)


def _place(e):
    return (e[1] is None, e[1] or 0, e[2])


def by_key(log):
    keys = {}
    for e in sorted(set(log), key=_place):
        keys.setdefault(e[0], []).append(e)
    return keys


def current(log, as_of=None):
    if as_of is not None:
        log = [e for e in log if e[1] is not None and e[1] <= as_of]
    return {events[-1] for events in by_key(log).values() if events[-1][3] != "d"}


def intervals(log, compact=False):
    """(k, v, from, to, is_current) per version, as a sorted list."""
    out = []
    for k, events in by_key(log).items():
        if compact:
            kept, before = [], None
            for e in events:
                same = before and before[3] != "d" and before[4] == e[4]
                if e[3] == "d" or not same:
                    kept.append(e)
                before = e
            events = kept
        for i, e in enumerate(events):
            to = events[i + 1][1] if i + 1 < len(events) else None
            if e[3] != "d":
                out.append((k, e[4], e[1], to, i + 1 == len(events)))
    return sorted(out, key=repr)


def pairs(log):
    out = []
    for events in by_key(log).values():
        for i, e in enumerate(events):
            out.append((events[i - 1][3] if i else None, e[3]))
    return out
