"""Hand-made customer messages with the edges of decoding and ordering."""

from __future__ import annotations

import json

from tidemark.streaming.messages import MESSAGE

TOPIC = "ecom.public.customers"


def row(key, name="n", email="e@x", country="c"):
    return {
        "customer_id": key,
        "full_name": name,
        "email": email,
        "country": country,
        "signup_date": 1,
        "updated_at": 2,
    }


def event(op, ts, after=None, before=None):
    return {"op": op, "ts_ms": ts, "before": before, "after": after}


def wrap(e):
    return {"schema": {"type": "struct"}, "payload": e}


CREATED_2 = event("c", 5, row(2, "two"))

EDGES = {
    0: wrap(event("r", 5, row(1, "first"))),
    1: event("u", 9, row(1, "tie lost")),
    2: event("u", 7, row(1, "late")),
    3: wrap(event("u", 9, row(1, "tie won"))),
    4: CREATED_2,
    5: event("d", 6, None, row(2, "two")),
    6: None,
    7: event("u", 4, row(2, "late")),
    8: event("c", 99, row(3, "dated")),
    9: event("c", None, row(3, "undated")),
    10: {"ts_ms": 5, "before": None, "after": row(4, "no op")},
    11: {"op": "t", "ts_ms": 8},
    12: "{bad",
    13: {"payload": None},
    14: event("u", 5, {}, row(5, "old")),
    15: event("c", 5, {**row(6, "extra"), "phone": "123"}),
    16: CREATED_2,
    17: "",
    18: "null",
    19: "[1]",
    20: "7",
    21: b"\xff\xfe{}",
    22: {"payload": None, "op": "u", "after": row(7, "shadowed")},
    23: {},
    24: {"payload": {}},
    25: event("c", 5, {**row(8, "bad type"), "signup_date": "soon"}),
    27: json.dumps(CREATED_2) + " and more",
    28: json.dumps(CREATED_2) + json.dumps(CREATED_2),
    29: json.dumps(CREATED_2) + "," + json.dumps(CREATED_2),
    30: "{'op': 'c', 'after': {'customer_id': 1}}",
    31: "  " + json.dumps(CREATED_2) + "\n",
    32: {"payload": "text"},
    33: {"op": "c", "after": "text"},
    26: event("c", 5, row(9, 'the "payload" of a plain event')),
}

DROPPED = {6, 11, 23, 24}
MALFORMED = {12, 13, 17, 18, 19, 20, 21, 22, 25, 27, 28, 29, 30, 32, 33}
ROWS = set(EDGES) - DROPPED - MALFORMED


def encode(value):
    if value is None or isinstance(value, bytes):
        return value
    return (value if isinstance(value, str) else json.dumps(value)).encode()


def frame(spark, values=None, topic=TOPIC):
    values = EDGES if values is None else values
    rows = [(topic, 0, offset, encode(v)) for offset, v in values.items()]
    return spark.createDataFrame(rows, MESSAGE)
