"""The operators as queries over the driver's tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat,
    collocations,
    exact_dedup,
    jaccard_join,
    licenses,
    line_templates,
    merkle,
    mixing,
    near_vectors,
    token_counts,
    toxicity,
    unigram,
    url_filter,
)

#: Where the files of public tokenizers are; read by the driver only.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR") or os.path.dirname(public_tokenizers.path("README.md"))

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_vectors(_table(spark, folder, "embeddings"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.learned(docs, _table(spark, folder, "labels"))
    held = docs.withColumn("held_out", F.coalesce(toxicity.held_out("doc_id"), F.lit(False)))
    return toxicity.score(held, model).drop("text")


def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    says = r"\### Assistant: </turn> ok"
    added = [(-7, 0, "user", says), (-7, 1, "assistant", says)]
    both = turns.unionByName(spark.createDataFrame(added, turns.schema))
    return chat.read_back(chat.format_conversations(both))


#: Shares of the expected tokens by domain.
MIX = {"high": 0.90, "low": 0.08, "toxic": 0.02}


def op4_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.document_rates(
        _table(spark, folder, "documents"), _table(spark, folder, "labels"), MIX
    )


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, folder, "documents"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, f"{TOKENIZERS}/byte_bpe_50k.json")


def op7_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return line_templates.drop_recurring_lines(docs)


def op8_unigram_pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return unigram.encode(docs, f"{TOKENIZERS}/piece_bpe_32k.model")


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return jaccard_join.similar_groups(docs, words=4, percent=85)


def op10_license_templates(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, folder, "documents").select("doc_id", "text"))


#: The longest rule that fits a url decides.
URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(_table(spark, folder, "pages"), URL_RULES)


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every leaf with its proof, and the root that a changed leaf would fold to."""
    docs = _table(spark, folder, "documents")

    def leaf(text: Column) -> Column:
        return merkle.leaf_of(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)

    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    other = F.when(tampered, leaf(F.translate("text", "\n", "")))
    leaves = docs.select("doc_id", "source", leaf(F.col("text")).alias("leaf"), other.alias("other"))
    proofs = merkle.manifest(leaves, "doc_id", "source", carry=["other"])
    refolded = merkle.folded(F.coalesce("other", "leaf"), F.col("levels"))
    return proofs.select(
        "doc_id", "leaf", "subroot", "root",
        merkle.proof_digest(F.col("levels")).alias("proof_sha256"),
        refolded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("lang", "text")
    return collocations.collocations(docs, least=100, top=2000)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_near_vectors, op2_toxicity, op3_chat_format, op4_source_mixing, op5_exact_dedup, op6_token_counts, op7_line_templates, op8_unigram_pieces, op9_jaccard_join, op10_license_templates, op11_url_filter, op12_merkle_manifest, op13_collocations)
}
