import re

import pytest
from brute import LONG, TEXTS, lower

from tidemark.llm import licenses

SCHEMA = "doc_id long, text string"


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def _base(text):
    words = _words(text)
    found = []
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    places = sorted(i for i, _ in found)
    labels = ",".join(sorted({label for _, label in found}))
    return len(words), len(found), *((places[0], places[-1]) if places else (None, None)), labels


def _pattern(markup):
    """The template as a regular expression over words that end in a space."""
    out = ""
    for token in re.findall(r"\[\[|\]\]|\{\d+-\d+\}|[^\s\[\]{}]+", markup):
        if token == "[[":
            out += "(?:"
        elif token == "]]":
            out += ")?"
        elif token[0] == "{":
            out += "(?:[^ ]+ ){%s,%s}" % tuple(token[1:-1].split("-"))
        else:
            out += re.escape(token) + " "
    return re.compile("(?<![^ ])" + out)


CASES = TEXTS + [
    (100, "Licensed under the Apache License, Version 2.0."),
    (101, "Licensed under the Apache License, Versions 2.0."),
    (102, "This work is licensed under the GNU General Public License, version 3 or any later version"),
    (103, "Copyright (c) 1999 by A. B. and others, all rights reserved; cc by by cc by"),
    (104, "Released under the MIT License" + " x" * 3 + " RELEASED UNDER THE MIT LICENSE"),
    (105, LONG + " general public license " + LONG),
    (106, "licensed under cc by nc sa 4.0 all rights all rights reserved"),
    (107, "this is in the public domain"), (108, "copyright all rights reserved"),
    (109, "ccby cc\nby general-public-license généralcc by"),
]


@pytest.fixture(scope="module")
def rows(spark):
    docs = spark.createDataFrame([(i, t, 7) for i, t in CASES], SCHEMA + ", labels int")
    return licenses.scan_licenses(docs).collect()


def test_base_phrases(rows):
    assert len(rows) == len(CASES)
    texts = dict(CASES)
    for r in rows:
        found = (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
        assert found == _base(texts[r.doc_id]), r.doc_id


def test_templates_equal_regular_expressions(rows):
    texts = dict(CASES)
    for r in rows:
        line = "".join(w + " " for w in _words(texts[r.doc_id]))
        labels = {label for label, t in licenses.TEMPLATES if _pattern(t).search(line)}
        labels |= set(filter(None, r.base_labels.split(",")))
        assert r.labels == ",".join(sorted(labels)), r.doc_id
        assert (r.score > 0) == bool(labels) and 0 <= r.score <= 1


def test_optional_and_replaceable_regions():
    number: dict[str, int] = {}
    a = licenses.compile_template("x", "a [[b [[c]]]] {1-2} d", number)

    def end(text):
        return licenses.match(a, [number.get(w, 0) for w in text.split()], 0)

    assert [end(t) for t in ("a z d", "a z z d", "a b z d", "a b c z d", "a b c d")] == [3, 4, 4, 5, 4]
    assert [end(t) for t in ("a d", "a z z z z d", "z a z d", "a")] == [-1, -1, -1, -1]
    with pytest.raises(ValueError):
        licenses.compile_template("x", "[[a]]", {})
    with pytest.raises(ValueError):
        licenses.compile_template("x", "a [[b", {})


def test_empty_table(spark):
    assert licenses.scan_licenses(spark.createDataFrame([], SCHEMA)).count() == 0


def _wordings(markup):
    """The shortest and the longest text of a template, and its mandatory words' places in the first."""
    tokens, depth = re.findall(r"\[\[|\]\]|\{\d+-\d+\}|[^\s\[\]{}]+", markup), 0
    short, long, fixed = [], [], []
    for token in tokens:
        if token in ("[[", "]]"):
            depth += 1 if token == "[[" else -1
        elif token[0] == "{":
            low, high = map(int, token[1:-1].split("-"))
            long += ["zork"] * high
            if not depth:
                short += ["zork"] * low
        else:
            long.append(token)
            if not depth:
                fixed.append(len(short))
                short.append(token)
    return short, long, fixed


def test_every_template_by_its_own_wording():
    """Both wordings are accepted whole; with any one mandatory word changed none is."""
    assert len({label for label, _ in licenses.TEMPLATES}) >= 25
    for label, markup in licenses.TEMPLATES:
        number = {}
        automaton = licenses.compile_template(label, markup, number)
        short, long, fixed = _wordings(markup)
        for words in (short, long):
            found = licenses.match(automaton, [number.get(w, 0) for w in words], 0)
            assert found == len(words), (label, words)
        for i in fixed:
            changed = [number.get(w, 0) for w in short[:i] + ["zork"] + short[i + 1 :]]
            assert licenses.match(automaton, changed, 0) < 0, (label, short[i])


def test_whole_notices(spark):
    notice = """/* This program is free software: you can redistribute it and/or modify it under the
    terms of the GNU Lesser General Public License as published by the Free Software Foundation,
    either version 2.1 of the License, or (at your option) any later version. */"""
    rows = [
        (1, notice, "gpl,lgpl-2.1"), (2, "// SPDX-License-Identifier: AGPL-3.0-or-later", "agpl-3.0"),
        (3, "Licensed under the Apache License, Version 2.0 (the \"License\");\n you may not use this"
            " file except in compliance with the License.\n", "apache-2.0"),
        (4, "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
            " without fee is hereby granted", "isc"),
        (5, notice.replace("Lesser", "").replace("2.1", "3"), "gpl,gpl-3.0"),
        (6, notice.replace("either version 2.1", "neither version 2.1"), "gpl"),
    ]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.scan_licenses(docs).collect()}
    assert got == {i: labels for i, _, labels in rows}
