"""Corpus preparation in stages; each stage reads what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, jaccard_join, mixing, toxicity, unigram
from tidemark.llm.queries import TOKENIZERS
from tidemark.llm.store import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go, as do no others."""
    model = toxicity.learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    own = docs.select("*").toDF(*[f"c{i}" for i in range(len(docs.columns))])
    scored = toxicity.score(own, model, f"c{docs.columns.index('text')}")
    return scored.where("predicted = 0").drop("score", "predicted").toDF(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts stays: five-word shingles, 0.8 or more."""
    return jaccard_join.drop_similar(docs, words=5, percent=80)


#: Shares of the expected tokens once toxic documents have gone, as a multiple of the tokens
#: before. Rates of one reading or more reach them; what is left of a toxic share has no target.
MIX = {"high": 0.9, "low": 0.1}
RATES = {"budget": 1.3, "lowest": 1.0, "highest": 4.0}


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat until the domains have their target weights; none goes."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mix(docs, labels, MIX, **RATES)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids in place of the texts."""
    return unigram.encode(docs, f"{TOKENIZERS}/piece_bpe_32k.model")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("source_mixing", mix_domains),
    ("unigram_pieces", encode_pieces),
]

#: Stages with learned models and tokenisers have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
