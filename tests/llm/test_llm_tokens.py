import json
import random

import numpy as np
import pyarrow as pa
import pytest
from brute import TEXTS
from tokenizers import Tokenizer

from tidemark.llm import token_counts
from tidemark.llm.batches import text_of
from tidemark.llm.queries import TOKENIZERS

PATH = f"{TOKENIZERS}/byte_bpe_50k.json"


@pytest.fixture(scope="module")
def counter():
    with open(PATH, encoding="utf-8") as file:
        return token_counts.Counter(json.load(file))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _same(counter, library, texts):
    got = counter.counts(*text_of(pa.array(texts, pa.string())))
    expected = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert got.tolist() == expected


def test_random_texts_equal_the_library(counter, library):
    rng = random.Random(1)
    letters = list("ab'srelvtmd  \n\t19é!。") + ["<|endoftext|>", "'ll", "<|end"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 300))) for _ in range(300)]
    _same(counter, library, texts)
    wide = [*range(32, 0x3000), *range(0x1F300, 0x1F700), 0x10FFFF]
    _same(counter, library, ["".join(map(chr, rng.choices(wide, k=120))) for _ in range(200)])


def test_every_white_space_and_class_edge(counter, library):
    edge = [chr(c) for c in range(0x3100) if not chr(c).isalpha()][::3]
    _same(counter, library, ["".join("a" + c + "1" + c + " " + c + "  " for c in edge)])


def test_chunks_do_not_change_words(counter):
    rng = random.Random(2)
    text = "".join(rng.choices("ab 'sre\n1.", k=5000))
    symbol = token_counts.symbols(
        np.frombuffer(text.encode("utf-32-le"), np.uint32), np.array([0]), counter.classes
    )
    state, starts = token_counts.BEGIN, []
    for i, s in enumerate(symbol):
        if token_counts._EMITS[state * 16 + s]:
            starts.append(i)
        state = token_counts._AFTER[state * 16 + s]
    assert token_counts.word_starts(symbol).tolist() == starts


def test_states_made_anew_count_the_same(counter, library):
    counter.words.MOST_STATES = 10
    counter.known.clear()
    _same(counter, library, ["antidisestablishmentarianism thshinger ououou"] * 2)
    del counter.words.MOST_STATES


def test_table(spark, library):
    rows = [(i, t, "kept", 1) for i, t in TEXTS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_tokens int")
    got = token_counts.count_tokens(docs, PATH)
    assert got.columns == ["doc_id", "lang", "n_bytes", "n_tokens", "over_limit"]
    found = sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect())
    expected = []
    for i, t in TEXTS:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected.append((i, len((t or "").encode()), n, n > 512))
    assert found == sorted(expected)
    assert token_counts.count_tokens(docs.limit(0), PATH).count() == 0


def test_one_long_word_keeps_the_table_small(counter, library, monkeypatch):
    """States are begun anew inside a word; the count is the library's."""
    rng = random.Random(3)
    word = "".join(rng.choices("etaoinshrdlu", k=60_000))
    monkeypatch.setattr(type(counter.words), "MOST_STATES", 500)
    counter.words.clear()
    _same(counter, library, [word, "some " + word[:20_000] + " more", word[::-1]])
    assert len(counter.words.states) <= 502 and len(counter.words.moves) <= 502 * 256
    long = np.frombuffer("".join(rng.choices("abcdefgh", k=2_000_000)).encode(), np.uint8)
    assert counter.words.count(long.tobytes()) > 100_000 and len(counter.words.states) <= 502
