"""Toxicity of texts: a linear classifier of character n-grams scaled by naive Bayes.

Which n-grams a text holds is all that counts. Each feature is scaled by its log-count
ratio, the logarithm of how much commoner it is in toxic texts, and a logistic regression
is fitted over the scaled features.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import once, pieces, text_of
from tidemark.llm.shingles import mixed
from tidemark.llm.store import bounded, maybe_in, stored

#: Character n-grams by length, hashed to this many features.
NGRAMS = (3, 4, 5, 6)
FEATURE_BITS = 20

#: Labelled texts per class that a model is fitted on at most (about), picked by hash.
TRAIN_ROWS = 3_000
#: Features must occur in so many of them; so many of the most telling ones are weighed.
MIN_TEXTS = 5
MOST_FEATURES = 8_000
#: Added to each count before ratios are taken.
SMOOTHING = 1.0
#: Weight decay and rounds of the regression.
DECAY, ROUNDS = 1.0, 120

#: Characters whose n-grams are hashed at once, and text bytes worked on at once: a sample's
#: texts keep all their n-grams meanwhile, some 100 bytes a byte of text.
_WINDOW = 1 << 16
PIECE_BYTES = 1 << 18

_ODD = np.random.Generator(np.random.PCG64(7)).integers(0, 2**63, 16, np.uint64) * np.uint64(
    2
) + np.uint64(1)


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The characters of a buffer of texts, a space before and after each, and their row."""
    n = len(offsets) - 1
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    lengths = np.diff(heads[offsets])
    row = np.repeat(np.arange(n, dtype=np.int32), lengths + 2)
    ends = np.cumsum(lengths + 2)
    inside = np.ones(len(row), bool)
    inside[ends - 1] = inside[ends - lengths - 2] = False
    padded = np.full(len(row), 32, np.uint32)
    padded[inside] = codes
    padded[(padded >= 65) & (padded <= 90)] += 32
    return padded, row


def _features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The feature of every n-gram of a buffer of texts, and the row it lies in, by windows.

    A-Z count as a-z.
    """
    padded, row = _padded(data, offsets)
    for start in range(0, len(padded), _WINDOW):
        codes = padded[start : start + _WINDOW + max(NGRAMS) - 1].astype(np.uint64)
        rows = row[start : start + _WINDOW + max(NGRAMS) - 1]
        for size in NGRAMS:
            m = min(_WINDOW, len(codes) - size + 1)
            if m <= 0:
                continue
            total = np.full(m, size, np.uint64)
            for j in range(size):
                total += codes[j : j + m] * _ODD[j]
            inside = rows[:m] == rows[size - 1 : size - 1 + m]
            hashed = mixed(total) >> np.uint64(64 - FEATURE_BITS)
            yield hashed[inside].astype(np.int32), rows[:m][inside]


def _pairs(features: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Row and feature as one number each, without repeats."""
    return np.unique(rows.astype(np.int64) << 32 | features)


class Model:
    """Weights by feature; ``score`` needs no more than they."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each text; every feature of a text counts once."""
        total = np.full(len(offsets) - 1, self.bias)
        held = []
        for features, rows in _features(data, offsets):
            some = self.weights[features] != 0
            held.append(_pairs(features[some], rows[some]))
        if held:
            pairs = np.unique(np.concatenate(held))
            np.add.at(total, pairs >> 32, self.weights[pairs & 0xFFFFFFFF])
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(text, label)`` of about TRAIN_ROWS labelled documents per class, picked by hash."""
    counts = {r[0]: r[1] for r in labels.groupBy("label").count().collect()}
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, min(1.0, TRAIN_ROWS / n)).otherwise(share)
    draw = F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(1 << 20)) / float(1 << 20)
    picked = stored(labels.where(draw < share), "labelled")
    return maybe_in(docs, picked, ["id"]).join(picked, "id").select("id", "text", "label")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from ``docs`` (id, text) and ``labels`` (id, label 0 or 1).

    The sample's feature sets are made on the cluster; they, bounded by TRAIN_ROWS, are
    what the driver fits. Without both labels in the sample every score is the share of
    label 1 among the labels (one half if there are none).
    """
    labels = labels.where("label IN (0, 1) AND id IS NOT NULL").dropDuplicates(["id"])
    share = labels.agg(F.avg("label")).first()[0]
    share = 0.5 if share is None else float(np.clip(share, 1e-4, 1 - 1e-4))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", PIECE_BYTES):
                data, offsets = text_of(piece.column("text"))
                found = [_pairs(*x) for x in _features(data, offsets)]
                pairs = np.unique(np.concatenate([np.empty(0, np.int64), *found]))
                cuts = np.searchsorted(pairs >> 32, np.arange(len(offsets)))
                flat = pa.array((pairs & 0xFFFFFFFF).astype(np.int32))
                lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), flat)
                columns = [piece.column("id"), piece.column("label").cast(pa.int32()), lists]
                yield pa.RecordBatch.from_arrays(columns, ["id", "label", "features"])

    made = stored(
        _sample(docs, labels).mapInArrow(held, "id long, label int, features array<int>"),
        "features",
    )
    counted = (
        made.select("label", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("q"))
        .where(F.col("p") + F.col("q") >= MIN_TEXTS)
    )
    n_p, n_q = made.agg(
        F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)
    ).first()
    weights = np.zeros(1 << FEATURE_BITS)
    prior = float(np.log(share / (1 - share)))
    if not n_p or not n_q:
        return Model(weights, prior)
    # Shares of texts that hold a feature, and their log ratio.
    p = (F.col("p") + SMOOTHING) / (n_p + 2 * SMOOTHING)
    q = (F.col("q") + SMOOTHING) / (n_q + 2 * SMOOTHING)
    telling = F.abs(F.log(p / q)) * F.sqrt(F.greatest("p", "q"))
    ratios = (
        counted.select("feature", F.log(p / q).alias("ratio"), telling.alias("telling"))
        .orderBy(F.desc("telling"), "feature")
        .limit(MOST_FEATURES)
        .collect()
    )
    if not ratios:
        return Model(weights, prior)
    ids = np.array([r[0] for r in ratios])
    ratio = np.array([r[1] for r in ratios])
    # From Arrow: a list would go through Python workers of its own.
    chosen = made.sparkSession.createDataFrame(pa.table({"feature": pa.array(ids, pa.int32())}))
    cells = (
        made.select("id", "label", F.explode("features").alias("feature"))
        .join(F.broadcast(chosen), "feature")
        .groupBy("id", "label")
        .agg(F.collect_list("feature").alias("features"))
    )
    # Texts without any chosen feature count too.
    rest = made.select("id", "label").join(cells.select("id"), "id", "left_anti")
    empty = [r[0] for r in rest.select("label").collect()]
    table = cells.orderBy("id").select("label", "features").toArrow().combine_chunks()
    lists = table.column("features").combine_chunks()
    column = np.full(1 << FEATURE_BITS, -1, np.int32)
    column[ids] = np.arange(len(ids))
    lengths = np.concatenate([lists.value_lengths().to_numpy(), np.zeros(len(empty), int)])
    fitted, bias = _regress(
        np.concatenate([table.column("label").to_numpy(), empty]).astype(float),
        column[lists.flatten().to_numpy()],
        np.repeat(np.arange(len(lengths), dtype=np.int32), lengths),
        ratio,
    )
    # The sample may hold more of label 1 than the labels do.
    weights[ids] = fitted * ratio
    return Model(weights, bias + prior - float(np.log(n_p / n_q)))


def _regress(
    y: np.ndarray, flat: np.ndarray, row: np.ndarray, ratio: np.ndarray
) -> tuple[np.ndarray, float]:
    """Weights over the scaled features, and the bias, by accelerated gradient descent.

    ``flat`` has the features of all texts and ``row`` the text of each.
    """
    scaled = ratio.astype(np.float32)[flat]
    n = len(y)
    w, b = np.zeros(len(ratio)), 0.0
    # A bound of the curvature: the largest squared length of a row, by power steps.
    v = np.ones(len(ratio)) / np.sqrt(len(ratio))
    size = 1.0
    for _ in range(15):
        v = np.bincount(flat, scaled * np.bincount(row, scaled * v[flat], n)[row], len(ratio))
        size = max(float(np.linalg.norm(v)), 1e-12)
        v /= size
    step = 1 / (0.25 * 1.1 * size + DECAY)
    bias_step = 4 / max(n, 1)
    look_w, look_b, t = w, b, 1.0
    for _ in range(ROUNDS):
        margin = np.bincount(row, scaled * look_w[flat], n) + look_b
        error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y
        grad = np.bincount(flat, scaled * error[row], len(ratio)) + DECAY * look_w
        new_w, new_b = look_w - step * grad, look_b - 0.5 * bias_step * float(error.sum())
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look_w = new_w + (t - 1) / t_next * (new_w - w)
        look_b = new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new_w, new_b, t_next
    return w, b


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on); text stays.

    Whole texts of any length are read; a null text scores as an empty one, equal texts
    score the same, an empty table gives an empty result. Columns called like the new ones
    are replaced.
    """
    content = pickle.dumps((model.weights.astype(np.float32), model.bias))
    key = f"toxicity:{zlib.crc32(content)}"
    shared = docs.sparkSession.sparkContext.broadcast(content)
    new = {"score": "double", "predicted": "int"}
    kept = [c for c in docs.columns if c not in new]
    types = dict(docs.dtypes)
    fields = [f"`{c}` {types[c]}" for c in kept] + [f"{c} {t}" for c, t in new.items()]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = once(key, lambda: Model(*pickle.loads(shared.value)))
        for batch in batches:
            for piece in pieces(batch, text, PIECE_BYTES):
                found = own.score(*text_of(piece.column(text)))
                columns = [piece.column(c) for c in kept]
                columns += [pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, [*kept, *new])

    return bounded(docs.select(*[f"`{c}`" for c in kept]).mapInArrow(scored, ", ".join(fields)))


def held_out(doc_id: str):
    """Whether a document's label is never learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def learned(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """A model of ``labels.toxic`` from the rows that are not held out."""
    named = labels.select(F.col(doc_id).cast("long").alias("id"), F.col("toxic").alias("label"))
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return fit(texts, named.where(~held_out("id")))
