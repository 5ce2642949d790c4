import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
from brute import LONG, sha

from tidemark.llm import chat
from tidemark.llm.batches import text_of
from tidemark.llm.queries import QUERIES
from tidemark.session import settings_for

SCHEMA = "conv_id long, turn long, role string, text string"
SAYS = r"\### Assistant: </turn> ok"


def _expected(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by_conv.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


def _found(df):
    return {
        r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()
    }


def _odd_rows():
    rng = random.Random(3)
    bits = ["\\", "### ", "</turn>", "</turn>\n", ": ", "a", "é🎉", "#", "<", " ", "\n", ""]
    roles = [None, "assistant", "user", "a: b\\", ""]
    rows = [
        (rng.choice([None, 1, 2, 3, 4]), rng.choice([None, 0, 1, 2]), rng.choice(roles),
         rng.choice([None, "".join(rng.choices(bits, k=rng.randint(0, 12)))]))
        for _ in range(300)
    ]
    return rows + rows[:5] + [(9, 0, "assistant", LONG), (9, 1, "user", LONG + SAYS)]


def test_round_trip_of_odd_turns(spark):
    rows = _odd_rows()
    runs = chat.format_conversations(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert _found(chat.read_back(runs)) == _expected(rows)


def test_long_conversations_are_several_runs(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i} " * 30) for i in range(400)]
    with settings_for(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        runs = chat.format_conversations(spark.createDataFrame(rows, SCHEMA))
        assert runs.select("run.task").distinct().count() > 1
        assert _found(chat.read_back(runs)) == _expected(rows)


def test_masks_cover_learned_texts_only(spark):
    rows = [(1, 0, "user", "é"), (1, 1, "assistant", SAYS), (1, 2, "assistant", "")]
    run = chat.format_conversations(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()
    texts = [
        chat.unescaped(r.formatted[s : s + n].encode()).decode()
        for r in run
        for s, n in zip(r.mask_starts, r.mask_lengths)
    ]
    assert texts == [SAYS, ""]


def test_assembly_equals_concatenation():
    roles, texts = ["user", "a:b", ""], ["x</turn>", "", "é ### \\"]
    out, at, begins, ends = chat.assemble(text_of(pa.array(roles)), text_of(pa.array(texts)))
    raw = out.tobytes()
    assert [raw[a:b].decode() for a, b in zip(at[:-1], at[1:])] == [
        "### user: x\\</turn></turn>\n", "### a\\:b: </turn>\n", "### : é \\### \\\\</turn>\n"
    ]
    assert [chat.unescaped(raw[a:b]).decode() for a, b in zip(begins, ends)] == texts
    assert list(chat.parse(raw)) == [(r.encode(), t.encode()) for r, t in zip(roles, texts)]
    assert np.all(np.diff(at) > 0)


def test_empty_table_and_other_columns(spark):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0
    rows = [(1, 0, "user", "x", "run", 5)]
    df = spark.createDataFrame(rows, SCHEMA + ", formatted string, n_turns int")
    assert _found(chat.read_back(chat.format_conversations(df))) == _expected([r[:4] for r in rows])


def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", SAYS), (-7, 1, "assistant", SAYS)]
    assert _found(QUERIES["op3_chat_format"](spark, folder)) == _expected(rows)
