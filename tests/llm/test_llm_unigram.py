import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from brute import TEXTS
from sentencepiece import sentencepiece_model_pb2

from tidemark.llm import unigram
from tidemark.llm.batches import text_of
from tidemark.llm.queries import TOKENIZERS

PATH = f"{TOKENIZERS}/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def vocabulary():
    return unigram.load_vocabulary(PATH)


@pytest.fixture(scope="module")
def model(vocabulary):
    return unigram.Unigram(vocabulary)


@pytest.fixture(scope="module")
def library(vocabulary):
    """The library's own unigram encoder over the same pieces and scores."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    for i, score in zip(vocabulary["normal"], vocabulary["scores"]):
        proto.pieces[i].score = score
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def _encoded(model, texts):
    ids, at = model.encode(*text_of(pa.array(texts, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


def test_equals_the_library(model, library, vocabulary):
    rng = random.Random(1)
    letters = list("ab the ing  \n\té一🎉ñ!.1") + ["tion", " of", "   "]
    texts = ["", " ", "▁", "a▁b"]
    texts += ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(500)]
    score = dict(zip(vocabulary["normal"], vocabulary["scores"]))
    for text, found in zip(texts, _encoded(model, texts)):
        expected = library.encode(text)
        if found != expected:  # equal sums may be broken otherwise
            sums = [sum(score.get(i, 0.0) for i in ids) for ids in (found, expected)]
            assert sums[0] == pytest.approx(sums[1], abs=1e-4), text
        assert library.decode(found) == library.decode(expected)


def test_side_by_side_equals_one_by_one(model):
    rng = random.Random(2)
    units = ["".join(rng.choices("theinonre é一", k=rng.randint(1, 15))).encode() for _ in range(400)]
    for unit, found in zip(units, model._side_by_side(units)):
        assert found.tolist() == model.best_path(unit).tolist()


def test_best_path_is_best(model, vocabulary):
    """Against all segmentations of short strings."""
    score = {model.keys[k]: s for k, s in enumerate(model.scores)}

    def best(data):
        if not data:
            return 0.0
        options = [best(data[n:]) + score[data[:n]] for n in range(1, len(data) + 1) if data[:n] in score]
        return max(options, default=float("-inf"))

    at = {i: s for i, s in zip(vocabulary["normal"], vocabulary["scores"])}
    for word in ("there", "onions", "tionre", "stand", "ingerst"):
        found = model.best_path(word.encode())
        assert sum(at[i] for i in found) == pytest.approx(best(word.encode()))


def test_trie_holds_every_piece(model):
    for k in range(0, len(model.keys), 37):
        node = 0
        for b in model.keys[k]:
            below = model.base[node] + b
            assert model.check[below] == node
            node = below
        assert model.keys[model.value[node]] == model.keys[k]


def test_invalid_byte_pieces_decode_to_replacements(model, vocabulary):
    ids = np.array([vocabulary["bytes"][0xFF], vocabulary["bytes"][0x41]])
    data, at = model.decode(ids, np.array([0, 2]))
    assert data.tobytes().decode() == "�A"


def test_tables_round_trip(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in TEXTS], "doc_id long, text string, ids int")
    coded = unigram.encode(docs, PATH)
    assert "text" not in coded.columns and dict(coded.dtypes)["ids"] == "array<int>"
    rows = coded.collect()
    assert len(rows) == len(TEXTS)
    assert {r.doc_id for r in rows if not r.round_trip} == {20}
    assert all(r.n_pieces == len(r.ids) for r in rows)
    assert {r.doc_id for r in rows if r.n_pieces == 0} == {4, 5}
    back = {(r.doc_id, r.text) for r in unigram.decode(coded, PATH).collect()}
    assert back == {(i, (t or "").replace("▁", " ")) for i, t in TEXTS}
    assert unigram.encode(docs.limit(0), PATH).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert [tuple(r) for r in unigram.decode(nothing, PATH).collect()] == [(1, "")]


def test_memory_does_not_grow_with_new_units(vocabulary):
    """Words never met before are solved in runs of a fixed number, and remembered closely."""
    rng = random.Random(3)
    words = ["".join(rng.choices("theinors", k=15)) for _ in range(20_000)]
    model = unigram.Unigram(vocabulary)
    data, offsets = text_of(pa.array([" ".join(words)]))
    tracemalloc.start()
    try:
        ids, _ = model.encode(data, offsets)
        held, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert peak < 26e6 and held < 6e6
    again = unigram.Unigram(vocabulary)
    assert ids.tolist() == [i for w in words for i in again.best_path(f" {w}".encode()).tolist()]
