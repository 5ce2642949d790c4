"""Mixing documents to target domain weights by soft membership.

A classifier learned from the labelled table gives each document a posterior over domains.
Each document gets a rate, how often it is to be read; the rates are fitted so that the
expected tokens of each domain, rate x tokens x posterior summed over all documents, meet
the targets by least squares. Rates never leave their bounds.

The fit goes by projected gradient steps with momentum: each moves all rates against the
gradient of the squared misses and projects them into their bounds, on the executors. A
domain's squared miss is weighted by one over its curvature (the mean squared posterior, by
tokens), so that rare domains are not met last. Rates depend on the posterior alone, so
documents with the same one move together, and a step needs one aggregate of a few sums.

Everything is DataFrame expressions: the driver only sees tables whose size is that of the
model (domains x features x bins) and one vector over the domains per step.
"""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import maybe_in, stored

DOMAINS = ("high", "low", "toxic")

#: Labelled documents whose words are compared at most (about), picked by hash.
WORD_SAMPLE = 10_000
#: Telling words kept per domain, and documents that a word must occur in.
MARKERS, MIN_DOCS = 100, 5
#: Bins of a measured feature, and what is added to each count.
BINS, SMOOTHING = 10, 1.0

#: Weight of staying at one reading of each document, steps at most, and the miss to stop at.
STAY, STEPS, TOLERANCE = 1e-5, 60, 1e-4

_MEASURED = ["variety", "word_length", "symbols", "capitals", "lines"]
_MARKED = [f"marks_{d}" for d in DOMAINS]


def domain_of(quality: Column, toxic: Column) -> Column:
    """The domain that a label row names: toxic, or else high or low quality; null if neither."""
    return (
        F.when(toxic == 1, "toxic").when(quality == 1, "high").when(quality == 0, "low")
    )


def _text(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(_text(text)), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _bare(words: Column) -> Column:
    """Distinct words without what leads and ends them."""
    return F.array_distinct(
        F.transform(words, lambda w: F.btrim(w, F.lit(".,;:!?\"'()[]|")))
    )


def _features(docs: DataFrame, text: str, markers: list[list[str]]) -> DataFrame:
    """``docs`` with what the classifier looks at, and ``_tokens``, the number of words."""
    bytes_ = F.greatest(F.length(_text(text)), F.lit(1))
    split = docs.withColumn("_words", _words(text)).withColumn("_bare", _bare(F.col("_words")))
    n = F.greatest(F.size("_words"), F.lit(1))
    lines = F.split(_text(text), "\n", -1)
    letters = F.length(F.regexp_replace(_text(text), r"[^\p{L}]+", ""))
    small = F.length(F.regexp_replace(_text(text), r"[^\p{Lu}]+", ""))
    gaps = F.regexp_count(_text(text), F.lit(r"[\x20\x09-\x0D]"))
    return split.withColumns(
        {
            "_tokens": F.size("_words").cast("long"),
            "variety": F.size("_bare") / n,
            "word_length": (F.length(_text(text)) - gaps) / n,
            "symbols": 1 - (letters + gaps) / bytes_,
            "capitals": small / F.greatest(letters, F.lit(1)),
            "lines": F.size(F.array_distinct(lines)) / F.size(lines),
            **{
                name: F.least(
                    F.size(F.array_intersect("_bare", F.array(*map(F.lit, marks)))), F.lit(BINS - 1)
                ).cast("double")
                if marks
                else F.lit(0.0)
                for name, marks in zip(_MARKED, markers)
            },
        }
    ).drop("_words", "_bare")


class Plan(NamedTuple):
    """All that rates depend on besides the document itself."""

    markers: list[list[str]]
    cuts: list[list[float]]
    scores: list[list[list[float]]]  # by feature, domain and bin
    priors: list[float]
    steps: list[list[float]]  # the steps taken: the pull of each domain, the stay's, the momentum
    lowest: float
    highest: float


# -- classifier --------------------------------------------------------------------------


def _markers(docs: DataFrame, labels: DataFrame, text: str) -> list[list[str]]:
    """For each domain the words that tell it apart most, by smoothed log ratio."""
    total = labels.count()
    draw = F.pmod(F.xxhash64("_id", F.lit("mixing")), F.lit(1 << 20)) / float(1 << 20)
    picked = stored(labels.where(draw < min(1.0, WORD_SAMPLE / max(total, 1))), "picked")
    sample = maybe_in(docs, picked, ["_id"]).join(picked, "_id")
    counts = (
        sample.select("_domain", F.explode(_bare(_words(text))).alias("word"))
        .groupBy("word")
        .agg(*[F.count_if(F.col("_domain") == d).alias(d) for d in DOMAINS])
        .withColumn("all", reduce(add, map(F.col, DOMAINS)))
        .where((F.col("all") >= MIN_DOCS) & (F.col("word") != ""))
    )
    counts = stored(counts, "words")
    sizes = {r[0]: r[1] for r in picked.groupBy("_domain").count().collect()}
    n = sum(sizes.values())
    out = []
    for d in DOMAINS:
        inside, outside = sizes.get(d, 0), n - sizes.get(d, 0)
        share = (F.col(d) + SMOOTHING) / (inside + 2 * SMOOTHING)
        others = (F.col("all") - F.col(d) + SMOOTHING) / (outside + 2 * SMOOTHING)
        telling = F.log(share / others) * F.sqrt(F.col(d))
        top = counts.where(share > 2 * others).orderBy(F.desc(telling), "word").limit(MARKERS)
        out.append([r[0] for r in top.select("word").collect()])
    return out


def _bin(name: str, cuts: list[float]) -> Column:
    return reduce(add, [(F.col(name) > c).cast("int") for c in cuts], F.lit(0))


def _learn(features: DataFrame, labels: DataFrame, markers: list[list[str]]) -> Plan:
    """Bin edges from the labelled documents, and each bin's share in each domain."""
    names = _MEASURED + _MARKED
    known = stored(features.join(labels, "_id").select("_domain", *names), "labelled")
    shares = [i / BINS for i in range(1, BINS)]
    row = known.agg(
        *[F.percentile_approx(c, F.array(*map(F.lit, shares)), 1000).alias(c) for c in _MEASURED]
    ).first()
    cuts = [sorted(set(row[c] or [])) for c in _MEASURED]
    cuts += [[i + 0.5 for i in range(BINS - 1)] for _ in _MARKED]
    cells = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("f"), _bin(c, cut).alias("b"))
                for i, (c, cut) in enumerate(zip(names, cuts))
            ]
        )
    )
    table = np.full((len(names), len(DOMAINS), BINS + 1), SMOOTHING)
    for i, cut in enumerate(cuts):
        table[i, :, len(cut) + 1 :] = 0
    rows = known.select("_domain", cells.alias("x")).groupBy("_domain", "x.f", "x.b").count()
    for d, f, b, n in rows.collect():
        table[f, DOMAINS.index(d), b] += n
    seen = table[0].sum(1) - SMOOTHING * (len(cuts[0]) + 1) + SMOOTHING
    shares = table / table.sum(2, keepdims=True)
    scores = np.log(np.maximum(shares, 1e-12))
    return Plan(
        markers, [list(map(float, c)) for c in cuts], scores.tolist(),
        np.log(seen / seen.sum()).tolist(), [], 0.0, float("inf"),
    )


def _posteriors(features: DataFrame, plan: Plan) -> DataFrame:
    """``features`` with ``_p0``, ``_p1``, ...: the posterior of each domain."""
    names = _MEASURED + _MARKED
    binned = features.withColumns(
        {f"_b{i}": _bin(c, cut) for i, (c, cut) in enumerate(zip(names, plan.cuts))}
    )
    logs = [
        reduce(
            add,
            [
                F.element_at(F.array(*map(F.lit, plan.scores[i][k])), F.col(f"_b{i}") + 1)
                for i in range(len(names))
            ],
            F.lit(plan.priors[k]),
        )
        for k in range(len(DOMAINS))
    ]
    scored = binned.withColumns({f"_l{k}": x for k, x in enumerate(logs)})
    most = F.greatest(*[f"_l{k}" for k in range(len(DOMAINS))])
    scored = scored.withColumns({f"_e{k}": F.exp(F.col(f"_l{k}") - most) for k in range(len(DOMAINS))})
    total = reduce(add, [F.col(f"_e{k}") for k in range(len(DOMAINS))])
    done = scored.withColumns({f"_p{k}": F.col(f"_e{k}") / total for k in range(len(DOMAINS))})
    return done.drop(
        *names, *[f"_b{i}" for i in range(len(names))],
        *[f"_{x}{k}" for x in "le" for k in range(len(DOMAINS))],
    )


# -- rates ---------------------------------------------------------------------------------


def _moved(plan: Plan, last: str) -> Column:
    """A field of the state after all steps: ``x`` the rate, ``b`` the one before, and ``u`` the
    place that the last step was taken from. All start at one reading, inside the bounds.

    The steps are one array value that a fold runs through, so the expression has the same
    size however many there are.
    """
    domains = range(len(DOMAINS))

    def projected(rate: Column) -> Column:
        least = F.greatest(rate, F.lit(plan.lowest))
        return least if plan.highest == float("inf") else F.least(least, F.lit(plan.highest))

    def step(at: Column, by: Column) -> Column:
        pull = reduce(add, [F.col(f"_p{k}") * by[k] for k in domains])
        # One value, so that it is worked out once.
        x = projected(at["y"] - pull - by[len(DOMAINS)] * (at["y"] - 1))
        new = F.transform(
            F.array(x), lambda x: F.struct(
                x.alias("x"), at["x"].alias("b"), at["y"].alias("u"),
                (x + by[len(DOMAINS) + 1] * (x - at["x"])).alias("y"),
            ),
        )
        return new[0]

    one = projected(F.lit(1.0))
    begin = F.struct(one.alias("x"), one.alias("b"), one.alias("u"), one.alias("y"))
    if not plan.steps:
        return begin[last]
    steps = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in plan.steps])
    return F.aggregate(steps, begin, step, lambda at: at[last])


def _rate(plan: Plan) -> Column:
    """The rate after all steps."""
    return _moved(plan, "x")


def _fit(
    posteriors: DataFrame, plan: Plan, targets: dict[str, float], budget: float,
    lowest: float, highest: float,
) -> Plan:
    """The steps that lead the expected domain tokens to the targets.

    Momentum is dropped whenever it points uphill. The fit ends when no target is missed by
    more than TOLERANCE of all tokens, or after STEPS steps.
    """
    names = [f"_p{k}" for k in range(len(DOMAINS))]
    profiles = stored(posteriors.groupBy(*names).agg(F.sum("_tokens").alias("_tokens")), "profiles")
    pairs = [F.sum(F.col("_tokens") * F.col(i) * F.col(j)) for i in names for j in names]
    total, *curves = profiles.agg(F.sum("_tokens"), *pairs).first()
    plan = plan._replace(steps=[], lowest=lowest, highest=highest)
    if not total:
        return plan
    named = np.array([d in targets for d in DOMAINS])
    want = np.array([targets.get(d, 0.0) for d in DOMAINS]) * budget
    curve = np.array(curves, float).reshape(len(names), -1) / total
    weights = named / np.maximum(np.diag(curve), 1e-9)
    scaled = np.sqrt(weights)[:, None] * curve * np.sqrt(weights)
    length = 1 / (np.linalg.eigvalsh(scaled).max() + STAY)

    def look(steps: list[list[float]]) -> tuple[np.ndarray, np.ndarray, float]:
        """Tokens by domain, what the last step changed of them, and whether that was uphill."""
        state = plan._replace(steps=steps)
        x, b, u, t = F.col("_x"), F.col("_b"), F.col("_u"), F.col("_tokens")
        columns = [_moved(state, c).alias(f"_{c}") for c in "xbu"]
        found = profiles.select("_tokens", *names, *columns).agg(
            *[F.sum(t * x * F.col(c)) for c in names],
            *[F.sum(t * (x - b) * F.col(c)) for c in names],
            F.sum(t * (u - x) * (x - b)),
        )
        sums = np.array(found.first(), float) / total
        return sums[: len(names)], sums[len(names) : -1], float(sums[-1])

    steps: list[list[float]] = []
    at, _, _ = look(steps)
    ahead, pace = at, 1.0
    while len(steps) < STEPS and np.abs(at - want)[named].max(initial=0) > TOLERANCE:
        pull = length * weights * (ahead - want)
        steps = [*steps, [*pull, length * STAY, 0.0]]
        at, change, uphill = look(steps)
        pace = 1.0 if uphill > 0 else pace
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        steps[-1][-1] = float((pace - 1) / faster)
        ahead, pace = at + steps[-1][-1] * change, faster
    return plan._replace(steps=steps)


def _labels(labels: DataFrame, doc_id: str) -> DataFrame:
    """One domain per labelled id; an id labelled several times takes the first by name."""
    return (
        labels.select(
            F.col(doc_id).cast("long").alias("_id"),
            domain_of(F.col("quality"), F.col("toxic")).alias("_domain"),
        )
        .where("_id IS NOT NULL AND _domain IS NOT NULL")
        .groupBy("_id")
        .agg(F.min("_domain").alias("_domain"))
    )


def _planned(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float], budget: float,
    lowest: float, highest: float, doc_id: str, text: str,
) -> tuple[Plan, DataFrame]:
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text"))
    named = stored(_labels(labels, doc_id), "domains")
    markers = _markers(rows, named, "_text")
    features = stored(_features(rows, "_text", markers).drop("_text"), "features")
    plan = _learn(features, named, markers)
    posteriors = stored(_posteriors(features, plan), "posteriors")
    return _fit(posteriors, plan, targets, budget, lowest, highest), posteriors


def _copies(doc_id: Column) -> Column:
    """Whole readings of a rate: its integer part, and one more by a draw from the id's hash."""
    draw = F.pmod(F.xxhash64(doc_id, F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("long")).cast("long")


def document_rates(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    budget: float = 1.0,
    lowest: float = 0.0,
    highest: float = float("inf"),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_tokens, p_<domain>..., rate and copies.

    ``targets`` has domains' shares of the expected tokens, ``budget`` their sum as a
    multiple of the documents' tokens (words); a domain without a target gets what the others
    bring along. Where bounds on the rates make the targets
    impossible, the least-squares nearest mix results. A document without words has the
    posterior its empty text gets, like any other; a null text counts as empty. Rows that
    repeat are documents each, an id may be null, and an empty table gives an empty result.
    Without usable labels all posteriors are equal.
    """
    plan, posteriors = _planned(docs, labels, targets, budget, lowest, highest, doc_id, text)
    return (
        posteriors.withColumn("rate", _rate(plan))
        .withColumn("copies", _copies(F.col("_id")))
        .select(
            F.col("_id").alias("doc_id"),
            F.col("_tokens").alias("n_tokens"),
            *[F.col(f"_p{k}").alias(f"p_{d}") for k, d in enumerate(DOMAINS)],
            "rate",
            "copies",
        )
    )


def mix(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    budget: float = 1.0,
    lowest: float = 0.0,
    highest: float = float("inf"),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` with each row as often as its copies say, columns unchanged.

    With ``lowest`` of at least 1 no document goes. Rates are worked out in place, so texts
    are not shuffled.
    """
    plan, _ = _planned(docs, labels, targets, budget, lowest, highest, doc_id, text)
    columns = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    own_id, own_text = (f"c{columns.index(c)}" for c in (doc_id, text))
    rated = _posteriors(_features(plain, own_text, plan.markers), plan)
    # A one-element explode: what follows is then not pushed under the classifier, where
    # each use of a column would repeat what it is made of.
    rated = rated.select(
        *plain.columns, F.explode(F.array(F.struct(_rate(plan).alias("rate")))).alias("_rated")
    ).select(*plain.columns, "_rated.rate")
    times = F.sequence(F.lit(1).cast("long"), F.col("_times"))
    return (
        rated.withColumn("_times", _copies(F.col(own_id).cast("long")))
        .where("_times > 0")
        .withColumn("_time", F.explode(times))
        .select(*plain.columns)
        .toDF(*columns)
    )
