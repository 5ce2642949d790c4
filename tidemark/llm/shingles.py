"""Hashed word shingles of texts, as numpy arrays."""

from __future__ import annotations

import numpy as np

from tidemark.llm.batches import spread

#: Bytes of words hashed at once; each takes some 60 bytes meanwhile.
_BLOCK = 1 << 17

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_RADIX = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(0, 2**64, 256, np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_PLACE = _rng.integers(0, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT = _rng.integers(0, 2**64, 64, np.uint64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def word_spans(
    data: np.ndarray, offsets: np.ndarray, apart: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and each text's first word; ``apart`` marks bytes between words."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~apart[data]
    word = inside[1:-1]
    starts = word & ~inside[:-2]
    ends = word & ~inside[2:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    starts[edges] = word[edges]
    ends[edges - 1] = word[edges - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash per word, A-Z lower-cased, and each text's first word."""
    starts, ends, first = word_spans(data, offsets, apart)
    lengths = ends - starts
    out = np.empty(len(starts), np.uint64)
    total = np.cumsum(lengths)
    low = 0
    while low < len(starts):
        done = total[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(total, done + _BLOCK, "right")))
        n = lengths[low:high]
        begin = np.cumsum(n) - n
        index = spread(starts[low:high], n)
        place = np.arange(len(index)) - np.repeat(begin, n)
        power = np.cumprod(np.full(int(n.max()) + 1, _RADIX))
        out[low:high] = np.add.reduceat(_BYTE[data[index]] * power[place], begin)
        low = high
    return mixed(out + lengths.astype(np.uint64) * _RADIX), first


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``k`` words.

    A text of fewer words has the hash of all of them; one without words has none.
    """
    words, first = word_hashes(data, offsets)
    n = max(0, len(words) - k + 1)
    runs = np.zeros(n, np.uint64)
    for j in range(k):
        runs += words[j : j + n] * _PLACE[j]
    runs = mixed(runs)
    sets = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= k:
            sets.append(np.unique(runs[a : b - k + 1]))
        elif b > a:
            whole = (words[a:b] * _PLACE[: b - a]).sum(keepdims=True) + _SHORT[b - a : b - a + 1]
            sets.append(mixed(whole))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets
