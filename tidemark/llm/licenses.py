"""Licence scans by template markup.

A template is the wording of a licence line with two kinds of regions: ``[[ ... ]]`` may be
left out, and ``{a-b}`` stands for any ``a`` to ``b`` words. It is compiled to an automaton
over words; a place in a text is accepted when its mandatory wording matches exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.batches import pieces, text_of
from tidemark.llm.shingles import word_hashes

#: Phrases whose every place is counted, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_GNU = (
    "[[this {1-2} is free software you can redistribute it and or modify it]] under the terms of"
    " [[version {0-1} [[only]] of]] the gnu {name} public license as published by the free software"
    " foundation either version {version} [[0]] of the license or at your option any later version"
)
_GNU_BRIEF = (
    "[[this {1-2} is]] licensed under the gnu {name} public license version {version} [[0]]"
    " [[or [[at your option]] any later version]]"
)
# Label and standard wording of licences. ``[[ ]]`` may be left out, ``{a-b}`` is any
# a to b words, and what punctuation parts is several words.
TEMPLATES = [
    # Lines that name a licence.
    ("apache-2.0", "licensed under the apache license [[version]] 2 [[0]]"),
    ("bsd", "redistribution and use in source and binary forms [[with or without modification]]"
            " [[are permitted]]"),
    ("cc-by-nc", "licensed under [[a]] [[the]] cc by nc [[sa]] [[nd]] {0-1} [[0]]"),
    ("cc-by-sa", "licensed under [[a]] [[the]] cc by sa {0-1} [[0]]"),
    ("cc-by-attribution", "licensed under [[a]] [[the]] creative commons attribution {0-3}"
                          " [[license]]"),
    ("copyright-notice", "copyright [[c]] {1-6} all rights reserved"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("isc", "licensed under the isc license"),
    ("public-domain", "[[this {1-2} is]] [[dedicated to]] [[in]] the public domain"),
    # Standard notices.
    *[
        (label, markup.replace("{name}", name).replace("{version}", version))
        for label, name, version in (
            ("gpl-2.0", "general", "2"), ("gpl-3.0", "general", "3"),
            ("lgpl-2.0", "library general", "2"), ("lgpl-2.1", "lesser general", "2 1"),
            ("lgpl-3.0", "lesser general", "3"), ("agpl-3.0", "affero general", "3"),
        )
        for markup in (_GNU, _GNU_BRIEF)
    ],
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this"
                   " file except in compliance with the license you may obtain a copy of the license"
                   " at {1-1} www apache org licenses license 2 0"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"
                " if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1"
                " the license you may not use this file except in compliance with the license"),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of"
                " the eclipse public license [[v]] 2 0"),
    ("epl-1.0", "this program and the accompanying materials are made available under the terms of"
                " the eclipse public license [[v]] 1 0"),
    ("bsl-1.0", "distributed under the boost software license version 1 0 see accompanying file"),
    ("cc0-1.0", "to the extent possible under law {1-12} has waived all copyright and related or"
                " neighboring rights to {1-12}"),
    ("artistic-2.0", "[[this {1-2} is]] licensed under the artistic license [[version]] 2 0"),
    # Whole texts, or the part of them that no other licence has.
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this"
            " software and associated documentation files the software to deal in the software"
            " without restriction including without limitation the rights to use copy modify merge"
            " publish distribute sublicense and or sell copies of the software and to permit persons"
            " to whom the software is furnished to do so subject to the following conditions [[the"
            " above copyright notice and this permission notice [[including the next paragraph]] shall"
            " be included in all copies or substantial portions of the software]] [[the software is"
            " provided as is without warranty of any kind express or implied including but not limited"
            " to the warranties of merchantability fitness for a particular purpose and noninfringement]]"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsd-2-clause", "redistribution and use in source and binary forms with or without modification"
                     " are permitted provided that the following conditions are met [[1]] redistributions"
                     " of source code must retain the above copyright notice this list of conditions and"
                     " the following disclaimer [[2]] redistributions in binary form must reproduce the"
                     " above copyright notice this list of conditions and the following disclaimer in the"
                     " documentation and or other materials provided with the distribution"),
    ("bsd-3-clause", "[[3]] neither the name of {1-10} nor the names of [[its]] {0-3} contributors may be"
                     " used to endorse or promote products derived from this software without specific"
                     " prior written permission"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or"
            " without fee is hereby granted [[provided that the above copyright notice and this"
            " permission notice appear in all copies]]"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is"
                  " free to copy modify publish use compile sell or distribute this software either in"
                  " source code form or as a compiled binary for any purpose commercial or non"
                  " commercial and by any means"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will"
             " the authors be held liable for any damages arising from the use of this software"
             " permission is granted to anyone to use this software for any purpose including"
             " commercial applications and to alter it and redistribute it freely"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a"
                " copy of the software and accompanying documentation covered by this license the"
                " software to use reproduce display distribute execute and transmit the software"),
    ("wtfpl", "do what the fuck you want to public license"),
    ("artistic-2.0", "this license establishes the terms under which a given free software package may"
                     " be copied modified distributed and or redistributed"),
    ("gpl-2.0", "gnu general public license version 2 june 1991"),
    ("gpl-3.0", "gnu general public license version 3 29 june 2007"),
    ("lgpl-2.1", "gnu lesser general public license version 2 1 february 1999"),
    ("lgpl-3.0", "gnu lesser general public license version 3 29 june 2007"),
    ("agpl-3.0", "gnu affero general public license version 3 19 november 2007"),
    ("apache-2.0", "apache license version 2 0 january 2004"),
    ("mpl-2.0", "mozilla public license version 2 0 1 definitions"),
    ("cc-by-4.0", "creative commons attribution 4 0 international [[public]] [[license]]"),
    ("cc-by-sa-4.0", "creative commons attribution sharealike 4 0 international [[public]] [[license]]"),
    ("cc-by-nc-4.0", "creative commons attribution noncommercial 4 0 international [[public]] [[license]]"),
    ("cc0-1.0", "cc0 1 0 universal"),
    # Machine-readable lines.
    *[
        (label, f"spdx license identifier {' '.join(re.findall('[a-z0-9]+', label))} [[only]] [[or later]]")
        for label in (
            "mit", "isc", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "gpl-2.0", "gpl-3.0",
            "lgpl-2.1", "lgpl-3.0", "agpl-3.0", "mpl-2.0", "epl-2.0", "unlicense", "cc0-1.0", "zlib",
            "bsl-1.0", "cc-by-4.0",
        )
    ],
]

#: Bytes between words; A-Z count as a-z.
APART = np.zeros(256, bool)
APART[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

_ANY = -1  # matches every word


class Automaton(NamedTuple):
    """States 0, 1, ...: for each the words that lead on, and whether it accepts."""

    label: str
    steps: list[dict[int, list[int]]]
    accepts: list[bool]
    firsts: set[int]


def compile_template(label: str, markup: str, number: dict[str, int]) -> Automaton:
    """The automaton of a template; ``number`` gets a number for each new word."""
    edges: list[list[tuple[int | None, int]]] = [[]]  # None: without reading a word

    def state() -> int:
        edges.append([])
        return len(edges) - 1

    tokens = re.findall(r"\[\[|\]\]|\{\d+-\d+\}|[^\s\[\]{}]+", markup)
    at, opened = 0, []
    for token in tokens:
        if token == "[[":
            opened.append(at)
            continue
        if token == "]]":
            edges[opened.pop()].append((None, at))
            # Nothing that begins here may be read as part of the optional region.
            after = state()
            edges[at].append((None, after))
            at = after
            continue
        if token[0] == "{":
            low, high = map(int, token[1:-1].split("-"))
            steps = [(_ANY, i >= low) for i in range(high)]
        else:
            steps = [(number.setdefault(token, len(number) + 1), False)]
        begun = []
        for word, optional in steps:
            after = state()
            edges[at].append((word, after))
            if optional:
                begun.append(at)
            at = after
        for skipped in begun:
            edges[skipped].append((None, at))
    if opened:
        raise ValueError(f"unclosed region in the template of {label}")

    def closure(start: int) -> set[int]:
        seen, todo = {start}, [start]
        while todo:
            for word, to in edges[todo.pop()]:
                if word is None and to not in seen:
                    seen.add(to)
                    todo.append(to)
        return seen

    steps, accepts = [], []
    for s in range(len(edges)):
        reached, leads = closure(s), {}
        for r in sorted(reached):
            for word, to in edges[r]:
                if word is not None:
                    leads.setdefault(word, []).append(to)
        steps.append(leads)
        accepts.append(at in reached)
    if accepts[0] or _ANY in steps[0]:
        raise ValueError(f"the template of {label} has to begin with a word")
    return Automaton(label, steps, accepts, set(steps[0]))


def match(automaton: Automaton, words: list[int], start: int) -> int:
    """The longest end of a place that begins at word ``start``, or -1."""
    states, best, at = {0}, -1, start
    while states and at < len(words):
        word = words[at]
        states = {
            to
            for s in states
            for key in (word, _ANY)
            if word or key == _ANY
            for to in automaton.steps[s].get(key, ())
        }
        at += 1
        if any(automaton.accepts[s] for s in states):
            best = at
    return best


class Scanner:
    """Base phrases and templates over one numbering of words."""

    def __init__(self, base: dict[str, str], templates: list[tuple[str, str]]):
        self.number: dict[str, int] = {}
        self.base = [compile_template(label, p, self.number) for p, label in base.items()]
        self.templates = [compile_template(label, t, self.number) for label, t in templates]
        data = [w.encode() for w in self.number]
        offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
        known, _ = word_hashes(np.frombuffer(b"".join(data), np.uint8), offsets, APART)
        order = np.argsort(known)
        self.hashes, self.numbers = known[order], np.arange(1, len(data) + 1)[order]
        by_first: dict[int, list[tuple[Automaton, bool]]] = {}
        for automaton in self.base + self.templates:
            for first in automaton.firsts:
                kind = any(automaton is b for b in self.base)
                by_first.setdefault(first, []).append((automaton, kind))
        self.by_first = by_first
        self.is_first = np.zeros(len(data) + 1, bool)
        self.is_first[list(by_first)] = True

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple]:
        """Per text: words, base places, first and last base start, both label sets, score."""
        hashes, first = word_hashes(data, offsets, APART)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        numbers = np.where(self.hashes[at] == hashes, self.numbers[at], 0)
        starts = np.flatnonzero(self.is_first[numbers])
        rows = [[int(n), 0, None, None, set(), set(), 0.0] for n in np.diff(first)]
        now, words = -1, []
        for start, text in zip(starts.tolist(), (np.searchsorted(first, starts, "right") - 1).tolist()):
            if text != now:
                now, words, begin = text, numbers[first[text] : first[text + 1]].tolist(), first[text]
            row, place = rows[text], int(start - begin)
            for automaton, is_base in self.by_first[words[place]]:
                end = match(automaton, words, place)
                if end < 0:
                    continue
                row[5].add(automaton.label)
                row[6] = max(row[6], (end - place) / (end - place + 2.0))
                if is_base:
                    row[1] += 1
                    row[2] = place if row[2] is None else row[2]
                    row[3] = place
                    row[4].add(automaton.label)
        return [(*r[:4], ",".join(sorted(r[4])), ",".join(sorted(r[5])), r[6]) for r in rows]


def scan_licenses(
    docs: DataFrame,
    text: str = "text",
    base: dict[str, str] = BASE,
    templates: list[tuple[str, str]] = TEMPLATES,
) -> DataFrame:
    """``docs`` without ``text``, with n_words, n_base, first_word, last_word, base_labels,
    labels and score.

    Every place of a base phrase counts, overlapping ones too; first_word and last_word are
    the smallest and largest word where one begins, null without any. labels has those of
    accepted templates besides the base ones; both are distinct, sorted and joined by
    commas, empty without any. score is n / (n + 2) for the longest accepted place of n words, 0
    without one. A null text is empty; texts are read whole, repeated rows each; an empty
    table gives an empty result. Columns called like the new ones are replaced.
    """
    new = {
        "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint",
        "base_labels": "string", "labels": "string", "score": "double",
    }
    kept = [c for c in docs.columns if c != text and c not in new]
    types = dict(docs.dtypes)
    fields = [f"`{c}` {types[c]}" for c in kept] + [f"{c} {t}" for c, t in new.items()]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, templates)
        for batch in batches:
            for piece in pieces(batch, text):
                rows = scanner.scan(*text_of(piece.column(text)))
                columns = [piece.column(c) for c in kept]
                columns += [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, [*kept, *new])

    return docs.select(*[f"`{c}`" for c in [*kept, text]]).mapInArrow(scanned, ", ".join(fields))
