"""Columns of Arrow batches as numpy arrays, in pieces of a bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Text bytes worked on at once; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20


def text_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about ``size`` text bytes."""
    _, offsets = text_of(batch.column(batch.schema.get_field_index(text)))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def parts(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The byte strings between consecutive ``cuts`` of ``data``, without copying them."""
    return pa.Array.from_buffers(
        pa.large_binary(),
        len(cuts) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(cuts, np.int64)), pa.py_buffer(data)],
    )


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all elements of runs: start, start + 1, ... for each run in turn."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A string column over UTF-8 bytes and offsets."""
    kind, at = (pa.string(), np.int32) if offsets[-1] < 2**31 else (pa.large_string(), np.int64)
    buffers = [None, pa.py_buffer(offsets.astype(at)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(kind, len(offsets) - 1, buffers)


_MADE: dict[str, object] = {}


def forget() -> None:
    """Give back what the worker holds from earlier operators: models, and Arrow's spare memory."""
    _MADE.clear()
    pa.default_memory_pool().release_unused()


class Recent:
    """Which of a stream of numbers came before, as far as a fixed number of places remembers.

    A number takes the place of another one now and then, and is new again then.
    """

    def __init__(self, places: int = 1 << 15) -> None:
        self._places: list[int | None] = [None] * places

    def is_new(self, x: int) -> bool:
        at = x % len(self._places)
        if self._places[at] == x:
            return False
        self._places[at] = x
        return True


def once(key: str, make: Callable[[], object]) -> object:
    """What ``make`` returns, made once per Python worker and kept for the latest key of a kind.

    ``key`` is ``kind:digest``, so a worker never holds two models of one kind.
    """
    if key not in _MADE:
        for old in [k for k in _MADE if k.split(":")[0] == key.split(":")[0]]:
            del _MADE[old]
        _MADE[key] = make()
    return _MADE[key]
