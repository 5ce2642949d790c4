"""The operators' results by plain Python, and a small table of awkward texts."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

LONG = " ".join(f"w{i % 97}x{i % 89}" for i in range(4000))
BASE = " ".join(f"tok{i}" for i in range(60))

#: doc_id, text: nulls, empty and very long texts, ties, repeated rows, near copies.
TEXTS = [
    (1, "The  quick\tbrown fox"), (2, "The quick brown fox"), (3, "the quick brown fox"),
    (4, None), (5, ""), (6, " \n\t"), (7, LONG), (8, LONG + " "), (9, LONG + " more"),
    (10, BASE), (11, BASE.replace("tok59", "other")), (12, BASE.replace("tok0 ", "other ")),
    (13, "one"), (14, "one"), (15, "one two"), (16, "日本語 テスト été"), (2, "The quick brown fox"),
    (17, "All rights reserved. CC BY, cc-by; General   Public\nLicense"),
    (18, "x\x0by\x0cz"), (19, "It's we'll <|endoftext|> 'tis"), (20, "▁ marker"),
]


def find(parent, a):
    while parent[a] != a:
        parent[a] = parent[parent[a]]
        a = parent[a]
    return a


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if 0 < len(words) < k:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def similar_groups(docs, k, percent):
    """Rows (doc_id, n_shingles, component_id)."""
    sets = [(i, shingles(t, k)) for i, t in docs]
    parent = list(range(len(sets)))
    for a, (_, x) in enumerate(sets):
        for b in range(a):
            y = sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[find(parent, a)] = find(parent, b)
    least = defaultdict(list)
    for a, (i, _) in enumerate(sets):
        if i is not None:
            least[find(parent, a)].append(i)
    return sorted(
        ((i, len(x), min(least[find(parent, a)], default=None)) for a, (i, x) in enumerate(sets)),
        key=str,
    )
