"""SentencePiece encoding by unigram Viterbi over a double-array trie, and decoding.

A text's white-space marker stands for each space, and one more leads a text that is not
empty. Among all ways to write the text as pieces the one with the best sum of log scores
is taken; a character without a piece costs an unknown penalty and becomes byte pieces.
No piece crosses from another character into a marker, and some characters occur in no
longer piece, so texts fall into short units that are solved on their own; distinct units
of a batch are solved side by side.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.batches import once, parts, pieces, spread, strings, text_of
from tidemark.llm.store import bounded

MARKER = "▁"
#: How far below the worst piece an unknown character scores.
UNKNOWN_PENALTY = 10.0
#: Units longer than this are solved one at a time.
LANE_BYTES = 48
#: Units solved side by side at once; their tables take about 2 KB each.
LANES = 4096
#: Text bytes encoded at once; a longer text is a piece of its own.
ENCODED_BYTES = 1 << 18


# -- vocabulary -------------------------------------------------------------------


def rank_scores(scores: list[float]) -> list[float]:
    """Log scores of a vocabulary that only ranks its pieces: Zipf's law over the ranks.

    Vocabularies made by merging carry the order of merges as their scores. A piece of
    rank r gets log(1 / r) less the logarithm of the harmonic sum; ties go by position.
    """
    order = sorted(range(len(scores)), key=lambda i: (-scores[i], i))
    total = float(np.log(np.sum(1.0 / np.arange(1, len(scores) + 1))))
    out = [0.0] * len(scores)
    for rank, i in enumerate(order, 1):
        out[i] = float(np.float32(-np.log(rank) - total))
    return out


def load_vocabulary(path: str) -> dict:
    """Pieces, their kinds and log scores from a ``.model`` file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    texts = [model.id_to_piece(i) for i in range(n)]
    special = [
        model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)
    ]
    byte = [model.is_byte(i) for i in range(n)]
    normal = [i for i in range(n) if not special[i] and not byte[i]]
    scores = [model.get_score(i) for i in normal]
    steps = [b - a for a, b in zip(scores, scores[1:]) if min(a, b) > -1e8]
    if all(s in (-1.0, 0.0) for s in steps):
        scores = rank_scores(scores)
    return {
        "texts": texts,
        "normal": normal,
        "scores": scores,
        "bytes": {int(texts[i][3:5], 16): i for i in range(n) if byte[i]},
        "unknown": model.unk_id(),
    }


def double_array(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base``, ``check`` and ``value`` of a trie: node n has child base[n] + byte if check
    there is n; value is the key's number or -1."""
    order = sorted(range(len(keys)), key=lambda i: keys[i])
    size = 1 << 16
    base, check, value = (np.full(size, -1, np.int32) for _ in range(3))
    check[0] = 0
    queue = [(0, 0, len(order), 0)]  # node, its range of sorted keys, depth
    free, hint = 256, 256  # the first free cell; where nodes of several children look
    while queue:
        node, low, high, depth = queue.pop()
        if len(keys[order[low]]) == depth:
            value[node] = order[low]
            low += 1
        children: list[tuple[int, int, int]] = []
        while low < high:
            b = keys[order[low]][depth]
            end = low
            while end < high and keys[order[end]][depth] == b:
                end += 1
            children.append((b, low, end))
            low = end
        if not children:
            continue
        labels = np.array([c[0] for c in children])
        while free < len(check) and check[free] >= 0:
            free += 1
        at = begin = (free if len(labels) == 1 else max(free, hint)) - int(labels[0])
        while True:
            if at + 256 >= len(check):
                base, check, value = (
                    np.concatenate([x, np.full(len(x), -1, np.int32)]) for x in (base, check, value)
                )
            if (check[at + labels] < 0).all():
                break
            at += 1
        if at - begin > 16:  # the cells passed are nearly full
            hint = at + int(labels[0])
        base[node] = at
        for b, start, end in children:
            check[at + b] = node
            queue.append((int(at + b), start, end, depth + 1))
    # A byte added to any base stays inside the arrays.
    room = np.full(256, -1, np.int32)
    return tuple(np.concatenate([x, room]) for x in (base, check, value))


# -- encoding ---------------------------------------------------------------------


class Unigram:
    """Encoder and decoder for a vocabulary."""

    #: Distinct units whose pieces are remembered, about 130 bytes each.
    MOST_UNITS = 1 << 17

    def __init__(self, vocabulary: dict):
        texts, normal = vocabulary["texts"], vocabulary["normal"]
        self.keys = [texts[i].encode() for i in normal]
        self.ids = np.array(normal, np.int32)
        self.scores = np.array(vocabulary["scores"], np.float64)
        self.unknown_score = float(self.scores.min()) - UNKNOWN_PENALTY
        self.base, self.check, self.value = double_array(self.keys)
        self.fallback = [vocabulary["bytes"].get(b, vocabulary["unknown"]) for b in range(256)]
        inner = {c for i in normal if len(texts[i]) > 1 for c in texts[i]}
        # Characters in no longer piece are units of their own (ASCII ones, to be quick).
        self.alone = np.array([b < 128 and chr(b) not in inner for b in range(256)])
        self.alone[ord(" ")] = False
        self.splits = all(
            MARKER not in texts[i].lstrip(MARKER) for i in normal
        )
        #: Pieces of units met before, as bytes: an array each would take three times the memory.
        self.known: dict[bytes, bytes] = {}
        # Bytes of each piece when decoded.
        shown = [b""] * len(texts)
        for i in normal:
            shown[i] = texts[i].replace(MARKER, " ").encode()
        for b, i in vocabulary["bytes"].items():
            shown[i] = bytes([b])
        shown[vocabulary["unknown"]] = " ⁇ ".encode()
        self.shown_at = np.concatenate([[0], np.cumsum([len(s) for s in shown])])
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.is_byte = np.zeros(len(texts), bool)
        self.is_byte[list(vocabulary["bytes"].values())] = True

    def marked(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts with a leading space each, unless empty; literal markers become spaces."""
        full = np.diff(offsets) > 0
        added = np.concatenate([[0], np.cumsum(full)])
        out = np.full(len(data) + added[-1], 32, np.uint8)
        at = np.arange(len(data)) + np.repeat(added[1:], np.diff(offsets))
        out[at] = data
        offsets = offsets + added
        raw = out.tobytes()
        if MARKER.encode() in raw:
            texts = [
                raw[a:b].replace(MARKER.encode(), b" ") for a, b in zip(offsets[:-1], offsets[1:])
            ]
            out = np.frombuffer(b"".join(texts), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        return out, offsets

    def unit_starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where units begin: texts, markers after other characters, characters apart."""
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets] = True
        if self.splits:
            space = data == 32
            begins[1:-1] |= space[1:] & ~space[:-1]
            alone = self.alone[data]
            begins[:-1] |= alone
            begins[1:] |= alone
        return np.flatnonzero(begins[:-1])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of the texts of a buffer, and their offsets."""
        data, offsets = self.marked(data, offsets)
        if not len(data):
            return np.empty(0, np.int32), np.zeros(len(offsets), np.int64)
        starts = self.unit_starts(data, offsets)
        units = parts(data, np.append(starts, len(data))).dictionary_encode()
        solved = self._solved(units.dictionary.to_pylist())
        lengths = np.array([len(s) for s in solved]) // 4
        begins = np.cumsum(lengths) - lengths
        index = units.indices.to_numpy()
        flat = np.frombuffer(b"".join(solved), np.int32)
        ids = flat[spread(begins[index], lengths[index])]
        sums = np.concatenate([[0], np.cumsum(lengths[index])])
        return ids, sums[np.searchsorted(starts, offsets)]

    def _solved(self, units: list[bytes]) -> list[bytes]:
        """The pieces of each unit, as the bytes of 32-bit ids."""
        if len(self.known) > self.MOST_UNITS:
            self.known.clear()
        new = [u for u in units if u not in self.known]
        short = [u for u in new if len(u) * 3 <= LANE_BYTES]
        long = {u: self.best_path(u).tobytes() for u in new if len(u) * 3 > LANE_BYTES}
        short.sort(key=len)  # units of a length together, so tables are as wide as need be
        for i in range(0, len(short), LANES):
            some = short[i : i + LANES]
            self.known.update(zip(some, (x.tobytes() for x in self._side_by_side(some))))
        return [self.known[u] if u in self.known else long[u] for u in units]

    def best_path(self, unit: bytes) -> np.ndarray:
        """The pieces of one unit: of equal sums the one whose last piece is longest."""
        data = unit.replace(b" ", MARKER.encode())
        n = len(data)
        best = [float("-inf")] * (n + 1)
        best[0] = 0.0
        back: list[tuple[int, int]] = [(-1, -1)] * (n + 1)
        base, check, value, scores = self.base, self.check, self.value, self.scores
        for start in range(n):
            if data[start] & 0xC0 == 0x80:
                continue
            head = data[start]
            width = 1 if head < 0x80 else 2 if head < 0xE0 else 3 if head < 0xF0 else 4
            node, single = 0, False
            for end in range(start, n):
                if base[node] < 0:
                    break
                below = base[node] + data[end]
                if check[below] != node:
                    break
                node = below
                key = value[node]
                if key >= 0:
                    single |= end + 1 == start + width
                    score = best[start] + scores[key]
                    if score > best[end + 1]:
                        best[end + 1], back[end + 1] = score, (start, int(key))
            if not single and best[start] + self.unknown_score > best[start + width]:
                best[start + width] = best[start] + self.unknown_score
                back[start + width] = (start, -1)
        out: list[int] = []
        at = n
        while at:
            start, key = back[at]
            if key >= 0:
                out.append(int(self.ids[key]))
            else:
                out.extend(self.fallback[b] for b in reversed(data[start:at]))
            at = start
        return np.array(out[::-1], np.int32)

    def _side_by_side(self, units: list[bytes]) -> list[np.ndarray]:
        """The same as ``best_path`` for many short units, a position of all at a time."""
        data = [u.replace(b" ", MARKER.encode()) for u in units]
        lengths = np.array([len(d) for d in data])
        order = np.argsort(-lengths, kind="stable")
        data = [data[i] for i in order]
        lengths = lengths[order]
        n, most = len(data), int(lengths[0])
        grid = np.zeros((n, most + 4), np.uint8)
        grid[np.repeat(np.arange(n), lengths), spread(np.zeros(n, np.int64), lengths)] = (
            np.frombuffer(b"".join(data), np.uint8)
        )
        best = np.full((n, most + 5), -np.inf)
        best[:, 0] = 0.0
        back = np.zeros((n, most + 5), np.int32)
        key = np.full((n, most + 5), -1, np.int32)
        for start in range(most):
            alive = int(np.searchsorted(-lengths, -start, "left"))  # units longer than start
            lane = np.flatnonzero((grid[:alive, start] & 0xC0) != 0x80)
            if not len(lane):
                continue
            head = grid[lane, start]
            width = 1 + (head >= 0xC0) + (head >= 0xE0) + (head >= 0xF0)
            single = np.zeros(len(lane), bool)
            node, here = np.zeros(len(lane), np.int32), np.arange(len(lane))
            for end in range(start, most):
                below = self.base[node] + grid[lane[here], end]
                goes = (
                    (self.base[node] >= 0)
                    & (self.check[below] == node)
                    & (lengths[lane[here]] > end)
                )
                here, node = here[goes], below[goes]
                if not len(here):
                    break
                found = self.value[node]
                hit = found >= 0
                at, piece = here[hit], found[hit]
                single[at] |= width[at] == end + 1 - start
                row = lane[at]
                score = best[row, start] + self.scores[piece]
                better = score > best[row, end + 1]
                row, piece = row[better], piece[better]
                best[row, end + 1] = score[better]
                back[row, end + 1], key[row, end + 1] = start, piece
            row, to = lane[~single], start + width[~single]
            score = best[row, start] + self.unknown_score
            better = score > best[row, to]
            row, to = row[better], to[better]
            best[row, to] = score[better]
            back[row, to], key[row, to] = start, -1
        out: list[np.ndarray] = [None] * n
        back_rows, key_rows, ids = back.tolist(), key.tolist(), self.ids
        for i in range(n):
            at, found, b, k = int(lengths[i]), [], back_rows[i], key_rows[i]
            while at:
                if k[at] >= 0:
                    found.append(ids[k[at]])
                else:
                    found.extend(self.fallback[c] for c in reversed(data[i][b[at] : at]))
                at = b[at]
            out[order[i]] = np.array(found[::-1], np.int32)
        return out

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes and offsets of the texts that ids stand for, without leading spaces."""
        begins, lengths = self.shown_at[ids], np.diff(self.shown_at)[ids]
        data = self.shown[spread(begins, lengths)]
        sums = np.concatenate([[0], np.cumsum(lengths)])
        offsets = sums[offsets]
        # The marker that leads a text goes again.
        heads = offsets[:-1][np.diff(offsets) > 0]
        heads = heads[data[heads] == 32]
        keep = np.ones(len(data), bool)
        keep[heads] = False
        offsets = offsets - np.searchsorted(heads, offsets, "left")
        data = data[keep]
        try:
            data.tobytes().decode()
        except UnicodeDecodeError:  # byte pieces that make no characters
            raw = data.tobytes()
            texts = [
                raw[a:b].decode(errors="replace").encode()
                for a, b in zip(offsets[:-1], offsets[1:])
            ]
            data = np.frombuffer(b"".join(texts), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        return data, offsets


# -- tables -----------------------------------------------------------------------


def _shared(df: DataFrame, path: str):
    """A function that gives the worker's encoder; the file is read once, here."""
    content = pickle.dumps(load_vocabulary(path))
    key = f"unigram:{zlib.crc32(content)}"
    held = df.sparkSession.sparkContext.broadcast(content)
    return lambda: once(key, lambda: Unigram(pickle.loads(held.value)))


def _schema(df: DataFrame, gone: set[str], new: dict[str, str]) -> tuple[list[str], str]:
    kept = [c for c in df.columns if c not in gone and c not in new]
    types = dict(df.dtypes)
    fields = [f"`{c}` {types[c]}" for c in kept] + [f"{c} {t}" for c, t in new.items()]
    return kept, ", ".join(fields)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` in place of ``text``, and what decoding them gives back.

    n_pieces counts the ids, n_bytes_fallback those that stand for single bytes,
    ids_sha256 is the digest of the ids as little-endian 32-bit numbers, and round_trip
    tells whether the decoded ids equal the text (they do unless it holds the marker
    itself). A null text counts as empty and has no ids. Texts of any length are encoded
    whole; rows that repeat are encoded each; an empty table gives an empty result. Columns
    called like the new ones are replaced.
    """
    encoder = _shared(docs, path)
    new = {
        "n_pieces": "bigint", "n_bytes_fallback": "bigint", "ids_sha256": "string",
        "round_trip": "boolean", "ids": "array<int>",
    }
    kept, schema = _schema(docs, {text}, new)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder()
        for batch in batches:
            pa.default_memory_pool().release_unused()
            for piece in pieces(batch, text, ENCODED_BYTES):
                data, offsets = text_of(piece.column(text))
                ids, at = model.encode(data, offsets)
                back, back_at = model.decode(ids, at)
                raw, again = data.tobytes(), back.tobytes()
                rows = range(len(offsets) - 1)
                same = [
                    raw[offsets[i] : offsets[i + 1]] == again[back_at[i] : back_at[i + 1]]
                    for i in rows
                ]
                digests = [
                    hashlib.sha256(ids[at[i] : at[i + 1]].astype("<i4")).hexdigest() for i in rows
                ]
                fallback = np.concatenate([[0], np.cumsum(model.is_byte[ids])])[at]
                columns = [piece.column(c) for c in kept]
                columns += [
                    pa.array(np.diff(at)), pa.array(np.diff(fallback)), pa.array(digests, pa.string()),
                    pa.array(same, pa.bool_()),
                    pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [*kept, *new])

    return bounded(docs.select(*[f"`{c}`" for c in [*kept, text]]).mapInArrow(encoded, schema))


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``rows`` with ``text`` in place of ``ids``: markers are spaces again, bytes characters.

    Null or empty ids give an empty text. Ids outside the vocabulary raise an error.
    """
    encoder = _shared(rows, path)
    kept, schema = _schema(rows, {ids}, {text: "string"})

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder()
        for batch in batches:
            lists = batch.column(ids)
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = model.decode(flat, at)
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, strings(data, offsets)], [*kept, text])

    return rows.select(*[f"`{c}`" for c in [*kept, ids]]).mapInArrow(decoded, schema)
