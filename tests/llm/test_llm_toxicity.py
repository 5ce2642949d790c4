from collections import Counter
import re
import random
import tracemalloc

import numpy as np
import pyarrow as pa
from brute import LONG, TEXTS

from tidemark.llm import toxicity
from tidemark.llm.batches import pieces, text_of
from tidemark.llm.queries import QUERIES
from tidemark.llm.store import stored

BAD = ["scoundrel", "knavish", "blackguard"]


def _corpus(n=400):
    rng = random.Random(4)
    clean = ["".join(rng.choices(["th", "er", "on", "an", "in"], k=rng.randint(1, 4))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(clean, k=rng.randint(5, 60))
        if i % 4 == 0:
            words[rng.randrange(len(words))] = rng.choice(BAD)
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    return docs, labels


def test_held_out_texts_are_told_apart(spark):
    docs, labels = _corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learned(df, known)
    held = df.where(toxicity.held_out("doc_id"))
    rows = toxicity.score(held, model).collect()
    truth = dict(labels)
    right = [r.predicted == truth[r.doc_id] for r in rows]
    assert len(rows) > 50 and np.mean(right) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, labels = _corpus(200)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    from pyspark.sql import functions as F

    turned = known.withColumn(
        "toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    a, b = toxicity.learned(df, known), toxicity.learned(df, turned)
    assert np.allclose(a.weights, b.weights) and a.bias == b.bias


def test_score_counts_each_feature_once_and_reads_whole_texts():
    weights = np.zeros(1 << toxicity.FEATURE_BITS)
    data, at = text_of(pa.array(["knavish"]))
    for features, _ in toxicity._features(data, at):
        weights[features] = 0.5
    model = toxicity.Model(weights, -4.0)
    texts = ["knavish", "knavish knavish knavish", LONG + " knavish", "", None, "KNAVISH"]
    got = model.score(*text_of(pa.array(texts, pa.string())))
    assert np.allclose(got[[1, 2, 5]], got[0]) and got[0] > 0.99
    assert np.allclose(got[3:5], 1 / (1 + np.exp(4)))


def test_windows_do_not_change_scores(monkeypatch):
    rng = np.random.default_rng(1)
    model = toxicity.Model(rng.normal(size=1 << toxicity.FEATURE_BITS) / 50, 0.0)
    texts = text_of(pa.array([t for _, t in TEXTS], pa.string()))
    whole = model.score(*texts)
    monkeypatch.setattr(toxicity, "_WINDOW", 37)
    assert np.allclose(model.score(*texts), whole)


def test_awkward_tables(spark):
    model = toxicity.Model(np.zeros(1 << toxicity.FEATURE_BITS), 0.0)
    docs = spark.createDataFrame([(i, t, "old") for i, t in TEXTS], "doc_id long, text string, score string")
    got = toxicity.score(docs, model)
    assert dict(got.dtypes)["score"] == "double" and got.count() == len(TEXTS)
    assert toxicity.score(docs.limit(0), model).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    empty = toxicity.learned(docs, none)
    assert not empty.weights.any() and empty.bias == 0.0
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 1), (3, 7)], "doc_id long, toxic int")
    assert not toxicity.learned(docs, odd).weights.any()


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op2_toxicity"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    found = rows.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").toPandas()
    bad = found.score[found.toxic == 1].to_numpy()[:, None]
    assert (bad > found.score[found.toxic == 0].to_numpy()).mean() > 0.75
    assert found.predicted[found.toxic == 0].mean() <= 0.05
    assert rows.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def _ngrams(text):
    padded = " " + re.sub("[A-Z]", lambda m: m[0].lower(), text) + " "
    return {padded[i : i + n] for n in (3, 4, 5, 6) for i in range(len(padded) - n + 1)}


def test_scores_equal_a_plain_fit(spark, monkeypatch):
    """Counts, log-count ratios and regression worked out in plain numpy from the same labels."""
    monkeypatch.setattr(toxicity, "ROUNDS", 3000)  # to the end, as the plain fit
    rng = random.Random(11)
    common = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu", "re") for b in ("nd", "st", "rk", "ll")]
    bad, good = ["grumf", "blarg", "snark"], ["peach", "cloud", "river"]
    rows = []
    for i in range(150):
        toxic = i % 3 == 0
        words = rng.choices(common, k=12) + rng.choices(bad if toxic != (rng.random() < 0.1) else good, k=2)
        rng.shuffle(words)
        rows.append((i, " ".join(words).capitalize(), int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "id long, label int")
    model = toxicity.fit(docs, labels)
    got = {r.id: r.score for r in toxicity.score(docs, model).collect()}
    sets, y = [_ngrams(r[1]) for r in rows], np.array([r[2] for r in rows], float)
    seen = Counter(g for s in sets for g in s)
    grams = sorted(g for g, n in seen.items() if n >= toxicity.MIN_TEXTS)
    held = np.array([[g in s for g in grams] for s in sets], float)
    p = (held[y == 1].sum(0) + 1) / (y.sum() + 2)
    q = (held[y == 0].sum(0) + 1) / (len(y) - y.sum() + 2)
    x = held * np.log(p / q)
    w, b = np.zeros(len(grams)), 0.0
    step = 1 / (np.linalg.norm(x, 2) ** 2 / 4 + 1)
    for _ in range(20_000):
        error = 1 / (1 + np.exp(-(x @ w + b))) - y
        w, b = w - step * (x.T @ error + w), b - 4 / len(y) * 0.5 * error.sum()
    want = 1 / (1 + np.exp(-(x @ w + b)))
    assert len(grams) < toxicity.MOST_FEATURES
    assert np.abs(np.array([got[r[0]] for r in rows]) - want).max() < 0.02


def _peak(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_of_features_is_bounded():
    """All n-grams of a piece, as the sample keeps them, and those of the windows of a long text."""
    rng = random.Random(6)
    texts = ["".join(rng.choices("theinors ", k=4_000)) for _ in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    model = toxicity.Model(np.ones(1 << toxicity.FEATURE_BITS, np.float32), 0.0)

    def kept():
        piece = next(pieces(batch, "text", toxicity.PIECE_BYTES))
        found = [toxicity._pairs(*x) for x in toxicity._features(*text_of(piece.column("text")))]
        np.unique(np.concatenate(found))

    def windows():
        for _ in toxicity._features(*text_of(pa.array(["".join(texts[:100])]))):
            pass

    model.score(*text_of(batch.column("text")))
    assert _peak(kept) < 32e6
    assert _peak(windows) < 12e6


def test_windows_change_no_score(monkeypatch):
    rng = np.random.default_rng(7)
    model = toxicity.Model(rng.normal(size=1 << toxicity.FEATURE_BITS).astype(np.float32), 0.1)
    texts = text_of(pa.array([t for _, t in TEXTS]))
    whole = model.score(*texts)
    for size in (1, 7, 1 << 18):
        monkeypatch.setattr(toxicity, "_WINDOW", size)
        assert (model.score(*texts) == whole).all()


def test_workers_get_a_megabyte_at_once(spark):
    docs = spark.createDataFrame([(i, f"{i} " * 3000) for i in range(300)], "doc_id long, text string")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "b"])

    found = stored(docs.coalesce(1).mapInArrow(sizes, "n long, b long"), "sizes").collect()
    assert sum(r.n for r in found) == 300 and max(r.b for r in found) < 1.2 * 2**20


def test_fit_needs_no_workers_for_its_features(spark, monkeypatch):
    """The telling features reach the cluster without a Python job over a list."""
    docs, labels = _corpus()
    texts = spark.createDataFrame(docs, "id long, text string")
    named = spark.createDataFrame(labels, "id long, label int")
    plain = type(spark).createDataFrame

    def watched(session, data, *args, **kwargs):
        assert not isinstance(data, list)
        return plain(session, data, *args, **kwargs)

    monkeypatch.setattr(type(spark), "createDataFrame", watched)
    model = toxicity.fit(texts, named)
    assert (model.weights != 0).sum() > 0
