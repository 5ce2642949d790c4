"""Chat formatting by columnar byte assembly, and reading formatted chats back.

A turn becomes ``### role: text</turn>`` and a line feed. Inside roles and texts a backslash
goes before every backslash, every ``</turn>`` and every ``### ``, and in roles before
every colon, so a marker without one is a real one and the rest comes back unchanged.

All turns of a batch are assembled at once: segment lengths give offsets, offsets give
scatter indices, and headers, contents and ends are copied into one buffer that becomes
the output column. A row of the output is a run of consecutive turns of a conversation;
most conversations are one row, and one of any length is several.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import spread, strings, text_of

HEAD, COLON, END = b"### ", b": ", b"</turn>\n"
_STOP = END[:-1]
_ESCAPE = ord("\\")

#: Text bytes of one output row at most, unless a single turn is longer.
RUN_BYTES = 1 << 20


def _at(data: np.ndarray, needle: bytes, offsets: np.ndarray) -> np.ndarray:
    """Marks the places where ``needle`` begins inside one of the strings."""
    n = len(data) - len(needle) + 1
    found = np.zeros(len(data), bool)
    if n <= 0:
        return found
    hit = data[:n] == needle[0]
    for i, b in enumerate(needle[1:], 1):
        hit &= data[i : i + n] == b
    places = np.flatnonzero(hit)
    ends = offsets[np.searchsorted(offsets, places, "right")]
    found[places[places + len(needle) <= ends]] = True
    return found


def escaped(
    data: np.ndarray, offsets: np.ndarray, colons: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Strings with a backslash before each byte that begins something special."""
    special = (data == _ESCAPE) | _at(data, _STOP, offsets) | _at(data, HEAD, offsets)
    if colons:
        special |= data == COLON[0]
    before = np.cumsum(special)
    out = np.full(len(data) + (int(before[-1]) if len(before) else 0), _ESCAPE, np.uint8)
    out[np.arange(len(data)) + before] = data
    return out, offsets + np.concatenate([[0], before])[offsets]


def _copy(out: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Scatters the strings of a buffer to their places ``at``."""
    out[spread(at, np.diff(offsets))] = data


def assemble(
    roles: tuple[np.ndarray, np.ndarray], texts: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All turns in one buffer: bytes, turn offsets, and where each text begins and ends."""
    role, role_at = escaped(*roles, colons=True)
    text, text_at = escaped(*texts)
    n = len(role_at) - 1
    parts = [
        np.full(n, len(HEAD)), np.diff(role_at), np.full(n, len(COLON)),
        np.diff(text_at), np.full(n, len(END)),
    ]
    lengths = np.stack(parts, 1).ravel()
    places = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    out = np.empty(int(places[-1]), np.uint8)
    at = places[:-1].reshape(n, 5)
    for column, fixed in ((0, HEAD), (2, COLON), (4, END)):
        for i, b in enumerate(fixed):
            out[at[:, column] + i] = b
    _copy(out, at[:, 1], role, role_at)
    _copy(out, at[:, 3], text, text_at)
    return out, np.append(at[:, 0], places[-1]), at[:, 3], at[:, 4]


def format_conversations(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learn: str = "assistant",
) -> DataFrame:
    """Formatted runs of turns: conv_id, run, n_turns, formatted, mask_starts, mask_lengths.

    Runs of a conversation follow one another by ``run``: the range of turns that their
    task had, and their place in it. The masks are the spans of
    ``formatted``, in code points, that hold the texts of the role to learn from. Turns are
    dealt by ranges of (conv_id, turn), so a conversation of any length is shared out over
    tasks; null turns come first, ties go by role and text, null roles and texts are empty,
    and repeated rows are turns each. A null conv_id is a conversation of its own. An empty
    table gives an empty result; other columns play no part.
    """
    rows = turns.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    order = ["conv_id", "turn", "role", "text"]

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, task = 0, TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            roles, texts = text_of(batch.column("role")), text_of(batch.column("text"))
            out, at, begins, ends = assemble(roles, texts)
            ids = batch.column("conv_id")
            number = ids.fill_null(-1).to_numpy()
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            changes = np.ones(batch.num_rows, bool)
            changes[1:] = (number[1:] != number[:-1]) | (known[1:] != known[:-1])
            changes[1:] |= at[1:-1] // RUN_BYTES != at[:-2] // RUN_BYTES
            first = np.flatnonzero(changes)
            bounds = np.append(first, batch.num_rows)
            chars = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])
            role_name = batch.column("role").to_pylist()
            masked = np.array([r == learn for r in role_name], bool)
            starts = chars[begins] - chars[at[first]][np.cumsum(changes) - 1]
            counts = np.concatenate([[0], np.cumsum(masked)])[bounds].astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(pa.array(counts), pa.array(x[masked].astype(np.int64)))
                for x in (starts, chars[ends] - chars[begins])
            ]
            heads = pa.array(first)
            run = pa.StructArray.from_arrays(
                [
                    pa.array(np.full(len(first), task, np.int32)),
                    pa.array(np.arange(part, part + len(first))),
                ],
                ["task", "part"],
            )
            part += len(first)
            yield pa.RecordBatch.from_arrays(
                [ids.take(heads), run, pa.array(np.diff(bounds)), strings(out, at[bounds]), *lists],
                ["conv_id", "run", "n_turns", "formatted", "mask_starts", "mask_lengths"],
            )

    return (
        rows.repartitionByRange("conv_id", "turn", "role", "text")
        .sortWithinPartitions(*order)
        .mapInArrow(
            formatted,
            "conv_id long, run struct<task: int, part: long>,"
            " n_turns long, formatted string, mask_starts array<long>, mask_lengths array<long>",
        )
    )


def unescaped(data: bytes) -> bytes:
    """What ``escaped`` was given: a backslash stands for the byte after it."""
    if b"\\" not in data:
        return data
    raw = np.frombuffer(data, np.uint8)
    keep = np.ones(len(raw), bool)
    at = np.flatnonzero(raw == _ESCAPE)
    # Of a run of backslashes every other one, beginning with the first, is an escape.
    run = np.ones(len(at), bool)
    run[1:] = at[1:] != at[:-1] + 1
    start = at[np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))]
    keep[at[(at - start) % 2 == 0]] = False
    return raw[keep].tobytes()


def _real(data: bytes, marker: bytes, start: int) -> int:
    """The next place of a marker without an escape, or -1."""
    while True:
        at = data.find(marker, start)
        if at < 0:
            return -1
        before = at
        while before > start and data[before - 1] == _ESCAPE:
            before -= 1
        if (at - before) % 2 == 0:
            return at
        start = at + 1


def parse(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """The (role, text) pairs of a formatted run."""
    at = 0
    while at < len(data):
        colon = _real(data, COLON, at + len(HEAD))
        end = _real(data, _STOP, colon + len(COLON))
        if not data.startswith(HEAD, at) or colon < 0 or end < 0:
            raise ValueError("not a formatted chat")
        yield unescaped(data[at + len(HEAD) : colon]), unescaped(data[colon + len(COLON) : end])
        at = end + len(END)


class _Reader:
    """Digests of one conversation, run by run."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def read(self, formatted: str, starts: list[int], lengths: list[int]) -> None:
        self.chars += len(formatted)
        for role, text in parse(formatted.encode()):
            self.n_turns += 1
            for part in (role, b"\n", text, b"\n"):
                self.turns.update(part)
        for start, length in zip(starts, lengths):
            text = unescaped(formatted[start : start + length].encode())
            self.loss.update(text)
            self.loss_chars += len(text.decode())

    def row(self) -> list:
        return [
            self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars
        ]


def read_back(runs: DataFrame) -> DataFrame:
    """Per conversation what its formatted runs say: digests of its turns and masked texts.

    conv_id, n_turns, turns_sha256 (role, line feed, text, line feed for each turn),
    loss_chars, loss_sha256 (all masked texts, unescaped) and formatted_chars. A digest has
    to read a conversation's runs in order; they stream by, so memory holds one of them.
    """
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(conv, reader: _Reader) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            data = [pa.array([v], t) for v, t in zip(reader.row(), kinds)]
            return pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), *data], ["conv_id", *names])

        now, reader = None, None
        for batch in batches:
            columns = [batch.column(c) for c in ("conv_id", "formatted", "mask_starts", "mask_lengths")]
            done = []
            for i in range(batch.num_rows):
                conv, formatted, starts, lengths = (c[i].as_py() for c in columns)
                if reader is None or conv != now:
                    if reader is not None:
                        done.append(row(now, reader))
                    now, reader = conv, _Reader()
                reader.read(formatted, starts, lengths)
            yield from done
        if reader is not None:
            yield row(now, reader)

    return (
        runs.select("conv_id", "run", "formatted", "mask_starts", "mask_lengths")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "run")
        .mapInArrow(
            read,
            "conv_id long, n_turns long, turns_sha256 string, loss_chars long,"
            " loss_sha256 string, formatted_chars long",
        )
    )
