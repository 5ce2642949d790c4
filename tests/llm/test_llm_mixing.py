import numpy as np
import pytest
from brute import TEXTS
from pyspark.sql import functions as F

from tidemark.llm import mixing
from tidemark.llm.queries import MIX

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels")]


@pytest.fixture(scope="module")
def rates(tables):
    return mixing.document_rates(*tables, MIX).toPandas()


def _shares(rates):
    total = rates.n_tokens.sum()
    return {d: (rates.rate * rates.n_tokens * rates[f"p_{d}"]).sum() / total for d in MIX}


def test_expected_tokens_meet_the_targets(rates, tables):
    assert len(rates) == tables[0].count() and (rates.rate >= 0).all()
    assert _shares(rates) == pytest.approx(MIX, abs=2e-3)
    assert np.allclose(rates[[f"p_{d}" for d in MIX]].sum(axis=1), 1)


def test_posteriors_follow_the_labels(rates, tables):
    labels = tables[1].withColumn("d", mixing.domain_of(F.col("quality"), F.col("toxic"))).toPandas()
    both = rates.merge(labels, on="doc_id")
    best = both[[f"p_{d}" for d in MIX]].to_numpy().argmax(axis=1)
    assert (np.array(list(MIX))[best] == both.d.to_numpy()).mean() > 0.85


@pytest.mark.parametrize("shares, lowest, highest", [((0.7, 0.2, 0.1), 0.0, 9.0), ((0.9, 0.05, 0.05), 0.5, 2.5)])
def test_rates_equal_plain_projected_gradient(spark, shares, lowest, highest):
    rng = np.random.default_rng(0)
    p = rng.dirichlet([1, 1, 1], 50)
    tokens = rng.integers(1, 100, 50)
    rows = [(int(t), *map(float, q)) for t, q in zip(tokens, p)]
    df = spark.createDataFrame(rows, "_tokens long, _p0 double, _p1 double, _p2 double")
    targets = dict(zip(mixing.DOMAINS, shares))
    plan = mixing.Plan([], [], [], [], [], 0.0, float("inf"))
    plan = mixing._fit(df, plan, targets, 1.5, lowest, highest)
    got = np.array([r[0] for r in df.select(mixing._rate(plan)).collect()])
    a, want = p * tokens[:, None] / tokens.sum(), 1.5 * np.array(shares)
    weights = 1 / (a * p).sum(0)  # a domain's squared miss counts by its curvature
    r = np.ones(50)
    for _ in range(100_000):
        r = np.clip(r - 0.3 * (p @ (weights * (a.T @ r - want)) + mixing.STAY * (r - 1)), lowest, highest)
    loss = lambda x: (weights * (a.T @ x - want) ** 2).sum()
    assert got.min() >= lowest and got.max() <= highest
    assert loss(got) <= 1.01 * loss(r) + 1e-6
    assert len(plan.steps) <= mixing.STEPS


def test_mix_repeats_and_keeps(spark, tables):
    docs, labels = tables
    odd = docs.select("text", "doc_id", F.lit(1).alias("rate"), F.lit("x").alias("_p0")).limit(300)
    mixed = mixing.mix(odd, labels, MIX, budget=1.2, lowest=1.0)
    assert mixed.columns == odd.columns
    counts = mixed.groupBy("doc_id").count().toPandas()
    assert set(counts.doc_id) == {r[0] for r in odd.select("doc_id").collect()}
    assert counts["count"].sum() > 300


def test_awkward_tables(spark):
    docs = spark.createDataFrame(TEXTS + [(None, "no id")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = mixing.document_rates(docs, none, MIX).toPandas()
    assert len(got) == len(TEXTS) + 1
    assert np.allclose(got[[f"p_{d}" for d in MIX]], 1 / 3)
    some = [(1, 1, 0), (1, 0, 0), (3, 0, 1), (None, 1, 0), (15, None, None)]
    labels = spark.createDataFrame(some, "doc_id long, quality int, toxic int")
    assert mixing.document_rates(docs, labels, MIX).count() == len(TEXTS) + 1
    assert mixing.document_rates(docs.limit(0), labels, MIX).count() == 0
