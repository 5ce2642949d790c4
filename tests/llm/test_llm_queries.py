import pytest
from compare import duckdb_result, spark_result

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm import exact_dedup, jaccard_join, mixing
from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_registered():
    assert len(QUERIES) == 13
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    assert spark_result(QUERIES[name](spark, FOLDER)) == duckdb_result(ORACLE[name], FOLDER)


@pytest.fixture(scope="module")
def stages(spark):
    from tidemark.llm.store import stored

    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(stored(stage(spark, docs[-1], FOLDER), name))
    return docs


def test_stages(spark, stages):
    first, clean, single, apart, mixed, last = stages
    assert all(d.columns == first.columns for d in stages[1:5])
    # Toxic documents go, and hardly any other.
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    gone = first.join(clean, "doc_id", "left_anti").join(labels, "doc_id").toPandas()
    assert len(gone) == 0 or gone.toxic.mean() > 0.6
    # One document of each group of copies stays: the others' groups are all there.
    texts = clean.select(exact_dedup.normalised("text").alias("t"))
    assert single.count() == texts.distinct().count()
    groups = jaccard_join.similar_groups(single, words=5, percent=80)
    kept = {r[0] for r in groups.where("doc_id = component_id").select("doc_id").collect()}
    assert {r[0] for r in apart.select("doc_id").collect()} == kept
    # Mixing repeats documents and drops none.
    assert mixed.count() >= apart.count()
    assert mixed.select("doc_id").distinct().count() == apart.count()
    assert last.count() == mixed.count() and last.where("NOT round_trip").count() == 0
    assert "ids" in last.columns and "text" not in last.columns


def test_mixing_reaches_the_pipelines_targets(spark, stages):
    apart, mixed = stages[3:5]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rates = mixing.document_rates(apart, labels, corpus_pipeline.MIX, **corpus_pipeline.RATES).toPandas()
    asked = {d: s * corpus_pipeline.RATES["budget"] for d, s in corpus_pipeline.MIX.items()}
    for domain, share in asked.items():
        reached = (rates.rate * rates.n_tokens * rates[f"p_{domain}"]).sum() / rates.n_tokens.sum()
        assert abs(reached - share) < 0.01
    assert rates.rate.between(1, 4).all() and rates.copies.sum() == mixed.count()


def test_run_gives_the_last_stage(spark, stages):
    assert corpus_pipeline.run(spark, FOLDER).columns == stages[-1].columns
