"""Token counts of byte-level BPE by finite-state transducers.

Two deterministic transducers count without making the tokens. The first reads classes of
characters and has a dozen states; its transitions emit 1 where a word (a unit that merges
never cross) begins. Texts are cut into chunks that are read side by side from every
state at once; the chunks' state maps are then composed by a prefix scan. The second reads
the bytes of a word; each transition carries by how much the number of tokens changes. Its
states are worked out when they are first reached: a state is what later bytes can depend
on, the places where a token may still be open and the token that ends before each.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.batches import once, parts, pieces, text_of

# -- words ----------------------------------------------------------------------

# Symbols: what a character is, as far as needed with what follows it.
LETTER, NUMBER, OTHER, QUOTE2, QUOTE3, SPACE_LAST, WHITE_LAST, WHITE_MORE = range(8)
# States: the unit that the last character belongs to.
BEGIN, LETTERS, NUMBERS, OTHERS, JOINED, WHITE, WHITES, SHORT, LONG1, LONG2, DONE = range(11)
_STATES = 11
CHUNK = 256


def _word_table() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emitted count for (state, symbol); symbols from 8 begin a text."""
    fresh = {
        LETTER: LETTERS, NUMBER: NUMBERS, OTHER: OTHERS, QUOTE2: SHORT, QUOTE3: LONG1,
        SPACE_LAST: JOINED, WHITE_LAST: WHITE, WHITE_MORE: WHITES,
    }
    after = np.empty((_STATES, 16), np.uint8)
    emits = np.ones((_STATES, 16), np.uint8)
    for symbol, state in fresh.items():
        after[:, [symbol, symbol + 8]] = state
    stays = [
        (LETTERS, LETTER, LETTERS), (NUMBERS, NUMBER, NUMBERS), (WHITES, WHITE_MORE, WHITES),
        (JOINED, LETTER, LETTERS), (JOINED, NUMBER, NUMBERS),
        (SHORT, LETTER, DONE), (LONG1, LETTER, LONG2), (LONG2, LETTER, DONE),
        *[(s, q, OTHERS) for s in (OTHERS, JOINED) for q in (OTHER, QUOTE2, QUOTE3)],
    ]
    for state, symbol, target in stays:
        after[state, symbol], emits[state, symbol] = target, 0
    return after.ravel(), emits.ravel()


_AFTER, _EMITS = _word_table()


def char_classes() -> np.ndarray:
    """For every code point: letter 0, number 1, other 2, white space 3."""
    import regex

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    table = np.full(0x110000, 2, np.uint8)
    for code, pattern in ((0, r"\p{L}+"), (1, r"\p{N}+"), (3, r"\s+")):
        for run in regex.finditer(pattern, every):
            found = every[run.start() : run.end()]
            table[[ord(c) for c in found]] = code
    return table


def _is_any(codes: np.ndarray, letters: str) -> np.ndarray:
    found = np.zeros(len(codes), bool)
    for c in letters:
        found |= codes == ord(c)
    return found


def symbols(codes: np.ndarray, begins: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The symbol of each character; ``begins`` are the places where a text begins."""
    kinds = classes[codes]
    n = len(codes)
    last = np.zeros(n, bool)  # the last character of its text
    last[begins[begins > 0] - 1] = True
    last[-1:] = True
    following = np.empty(n, np.uint8)
    following[:-1], following[-1:] = kinds[1:], 3
    following[last] = 3
    out = kinds.copy()  # the first three symbols are the classes
    white = kinds == 3
    ends = white & (following != 3)
    out[white] = WHITE_MORE
    out[ends] = np.where(codes[ends] == ord(" "), SPACE_LAST, WHITE_LAST)
    for at in np.flatnonzero(codes == ord("'")):
        follow = codes[at + 1 : at + 3]
        if last[at] or not len(follow):
            continue
        if chr(follow[0]) in "stmd":
            out[at] = QUOTE2
        elif len(follow) == 2 and not last[at + 1]:
            if chr(follow[0]) + chr(follow[1]) in ("re", "ve", "ll"):
                out[at] = QUOTE3
    out[begins[begins < n]] += 8
    return out


def word_starts(symbol: np.ndarray) -> np.ndarray:
    """Where words begin, by chunk state maps that a prefix scan composes."""
    n = len(symbol)
    lanes = max(1, -(-n // CHUNK))
    padded = np.full(lanes * CHUNK, WHITE_MORE, np.uint8)
    padded[:n] = symbol
    columns = np.ascontiguousarray(padded.reshape(lanes, CHUNK).T).astype(np.uint8)
    # The map of a chunk: its last state from each first one, all states side by side.
    maps = np.repeat(np.arange(_STATES, dtype=np.uint8)[:, None], lanes, 1)
    for symbols_at in columns:
        maps = _AFTER[maps * np.uint8(16) + symbols_at]
    # maps[:, i] comes to cover chunks 0..i: it doubles its reach in every step.
    reach = 1
    while reach < lanes:
        maps = np.concatenate(
            [maps[:, :reach], np.take_along_axis(maps[:, reach:], maps[:, :-reach], 0)], 1
        )
        reach *= 2
    state = np.concatenate([[BEGIN], maps[BEGIN, :-1]]).astype(np.uint8)
    emitted = np.empty((CHUNK, lanes), np.uint8)
    for i, symbols_at in enumerate(columns):
        step = state * np.uint8(16) + symbols_at
        emitted[i] = _EMITS[step]
        state = _AFTER[step]
    return np.flatnonzero(emitted.T.ravel()[:n])


# -- tokens of a word -------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for
    themselves, the others for letters from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeTransducer:
    """Counts the tokens of a word; states are made when they are first reached."""

    #: States kept before the table starts anew.
    MOST_STATES = 250_000

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        letters = byte_letters()
        self.bytes_of = {
            i: bytes(letters[c] for c in t)
            for t, i in vocab.items()
            if all(c in letters for c in t)
        }
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.merge = {
            (vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)
        }
        # Trie over the tokens' bytes: node * 256 + byte -> node.
        self.child: dict[int, int] = {}
        self.token_at = [-1]
        self.inner = [True]
        for data, token in self.id_of.items():
            node = 0
            for b in data:
                self.inner[node] = True
                key = node << 8 | b
                if key not in self.child:
                    self.child[key] = len(self.token_at)
                    self.token_at.append(-1)
                    self.inner.append(False)
                node = self.child[key]
            self.token_at[node] = token
        self.fits: dict[tuple[int, int], bool] = {}
        self.moves: dict[int, tuple[int, int]] = {}
        self.clear()

    def clear(self) -> None:
        begin = ((0, -1, 0),)
        self.states = [begin]
        self.number = {begin: 0}
        self.moves.clear()

    def merged(self, data: bytes) -> list[int]:
        """Tokens of a few bytes by repeated merging; used to compile transitions only."""
        tokens = [self.id_of[bytes([b])] for b in data]
        while len(tokens) > 1:
            found = [self.merge.get(pair) for pair in zip(tokens, tokens[1:])]
            ranks = [f for f in found if f]
            if not ranks:
                break
            best = min(ranks)
            out, i = [], 0
            while i < len(tokens):
                if i + 1 < len(tokens) and found[i] == best:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(tokens[i])
                    i += 1
            tokens = out
        return tokens

    def fit(self, before: int, token: int) -> bool:
        """Whether ``token`` can follow ``before`` (-1: begin a word) with no merge across."""
        key = (before, token)
        if key not in self.fits:
            data = self.bytes_of[token]
            if before < 0:
                self.fits[key] = self.merged(data) == [token]
            else:
                self.fits[key] = self.merged(self.bytes_of[before] + data) == [before, token]
        return self.fits[key]

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """Next state and change of the token count."""
        ended, grown = None, []
        for node, before, rel in self.states[state]:
            below = self.child.get(node << 8 | byte)
            if below is None:
                continue
            token = self.token_at[below]
            if ended is None and token >= 0 and self.fit(before, token):
                ended = (token, rel + 1)
            if self.inner[below]:
                grown.append((below, before, rel))
        token, change = ended
        after = tuple((node, before, rel - change) for node, before, rel in grown)
        after += ((0, token, 0),)
        number = self.number.get(after)
        if number is None and len(self.states) > self.MOST_STATES:
            # Begun anew inside a word too, so that no word makes the table grow without bound.
            self.clear()
            return self._numbered(after), change
        number = self.moves[state << 8 | byte] = (self._numbered(after), change)
        return number

    def _numbered(self, state: tuple) -> int:
        number = self.number.get(state)
        if number is None:
            number = self.number[state] = len(self.states)
            self.states.append(state)
        return number

    def count(self, word: bytes) -> int:
        state = total = 0
        known = self.moves.get
        for byte in word:
            state, change = known(state << 8 | byte) or self.step(state, byte)
            total += change
        return total


# -- texts ------------------------------------------------------------------------


class Counter:
    """Token counts of texts for one tokenizer file."""

    #: Distinct words whose counts are remembered.
    MOST_WORDS = 300_000

    def __init__(self, spec: dict):
        model = spec["model"]
        split = spec["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError("a byte-level BPE tokenizer without normalizer is needed")
        if split["add_prefix_space"] or not split["use_regex"]:
            raise ValueError("the tokenizer must split by its pattern, without a prefix")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.words = MergeTransducer(model["vocab"], pairs)
        self.classes = char_classes()
        added = [t["content"].encode() for t in spec["added_tokens"]]
        self.special = re.compile(b"|".join(map(re.escape, added))) if added else None
        self.known: dict[bytes, int] = {}

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text of a buffer."""
        n_texts = len(offsets) - 1
        if not len(data):
            return np.zeros(n_texts, np.int64)
        cuts, special = offsets[:-1], np.empty(0, np.int64)
        if self.special:
            raw = data.tobytes()
            # A match must lie inside one text.
            spans = [
                m.span() for m in self.special.finditer(raw)
                if np.searchsorted(offsets, m.start(), "right")
                == np.searchsorted(offsets, m.end(), "left")
            ]
            special = np.array([s for s, _ in spans], np.int64)
            cuts = np.unique(np.concatenate([cuts, special, [e for _, e in spans]]).astype(np.int64))
        heads = (data & 0xC0) != 0x80  # the first byte of each character
        codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        char_at = np.cumsum(heads) - 1  # character of each byte
        cuts = cuts[cuts < len(data)]
        symbol = symbols(codes, np.unique(char_at[cuts]), self.classes)
        starts = np.flatnonzero(heads)[word_starts(symbol)]
        if len(special):  # a special string is one word, whatever it holds
            inside = np.zeros(len(data) + 1, bool)
            for a, b in spans:
                inside[a + 1 : b] = True
            starts = starts[~inside[starts]]
        words = parts(data, np.append(starts, len(data))).dictionary_encode()
        per_word = self._known(words.dictionary.to_pylist())[words.indices.to_numpy()]
        if len(special):
            per_word[np.searchsorted(starts, special)] = 1
        sums = np.concatenate([[0], np.cumsum(per_word)])
        at = np.searchsorted(starts, offsets)
        return sums[at[1:]] - sums[at[:-1]]

    def _known(self, words: list[bytes]) -> np.ndarray:
        known, count = self.known, self.words.count
        if len(known) > self.MOST_WORDS:
            known.clear()
        out = np.empty(len(words), np.int64)
        for i, word in enumerate(words):
            n = known.get(word)
            if n is None:
                n = count(word)
                if len(word) < 64:
                    known[word] = n
            out[i] = n
        return out


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """``docs`` without ``text``, with n_bytes, n_tokens and over_limit (more than ``limit``).

    ``path`` names a tokenizer file; it is read once, here. Counts are those of the whole
    text without added tokens; a special string inside a text is one token. A null text is
    empty and has no tokens. Very long texts are read in chunks like all others; repeated
    rows are counted each; an empty table gives an empty result. Of columns that are called
    like the three new ones the new ones stay.
    """
    with open(path, encoding="utf-8") as file:
        content = file.read()
    key = f"token-counts:{zlib.crc32(content.encode())}"
    shared = docs.sparkSession.sparkContext.broadcast(content)
    new = {"n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}
    kept = [c for c in docs.columns if c not in {text, *new}]
    types = dict(docs.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in kept] + [f"{c} {t}" for c, t in new.items()])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = once(key, lambda: Counter(json.loads(shared.value)))
        for batch in batches:
            for piece in pieces(batch, text):
                data, offsets = text_of(piece.column(text))
                n = counter.counts(data, offsets)
                columns = [piece.column(c) for c in kept]
                columns += [pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)]
                yield pa.RecordBatch.from_arrays(columns, [*kept, *new])

    return docs.select(*[f"`{c}`" for c in [*kept, text]]).mapInArrow(counted, schema)
