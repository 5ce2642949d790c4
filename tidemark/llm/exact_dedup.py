"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import maybe_in, stored

#: Code points of a normalised text that the second refinement looks at.
PREFIX = 64

_OWN = ["_len", "_prefix", "_full", "_row", "_first", "_n"]


def normalised(text: str) -> Column:
    """A text with each run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _shaped(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the length of the normalised text and the hash of its beginning."""
    return docs.withColumns(
        {
            "_len": F.octet_length(normalised(text)),
            "_prefix": F.xxhash64(F.substring(normalised(text), 1, PREFIX)),
        }
    )


def _full(text: str) -> Column:
    return F.sha2(normalised(text), 256)


def surviving_keys(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(_len, _prefix)`` of more than one row, found in rows of two numbers.

    Prefix hashes are grouped only for rows whose length is not unique.
    """
    shapes = stored(_shaped(docs, text).select("_len", "_prefix"), "shapes")
    lengths = shapes.groupBy("_len").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return stored(
        maybe_in(shapes, lengths, ["_len"])
        .groupBy("_len", "_prefix")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select("_len", "_prefix"),
        "surviving",
    )


def _groups(rows: DataFrame, doc_id: str) -> DataFrame:
    """Per full hash: the row that stays and the number of rows.

    Hot hashes shrink in the task that reads them. The smallest ``doc_id`` wins, nulls
    last, and ``_row`` breaks the tie of rows that repeat a ``doc_id``.
    """
    place = F.struct(F.col(doc_id).isNull(), F.col(doc_id).alias("id"), F.col("_row").alias("row"))
    return rows.groupBy("_full").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"))


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept and text_sha256.

    Texts are equal when their normalised forms are. Only rows that share length and
    prefix hash with another one are grouped by the hash of their full text, and no text is
    ever shuffled. Null texts count as empty texts; a null doc_id is kept only by a group
    without another id; of rows that repeat id and text one is kept. An empty table gives
    an empty result; further columns are ignored, whatever their names.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    keys = surviving_keys(rows, "_text")
    shaped = _shaped(rows, "_text")
    alone = maybe_in(shaped, keys, ["_len", "_prefix"], keep=False).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        _full("_text").alias("text_sha256"),
    )
    candidates = stored(
        maybe_in(shaped, keys, ["_len", "_prefix"]).select(
            "doc_id", _full("_text").alias("_full"), F.monotonically_increasing_id().alias("_row")
        ),
        "candidates",
    )
    grouped = candidates.join(_groups(candidates, "doc_id"), "_full").select(
        "doc_id",
        F.col("_first.id").alias("keep_id"),
        F.col("_n").alias("group_size"),
        (F.col("_row") == F.col("_first.row")).alias("kept"),
        F.col("_full").alias("text_sha256"),
    )
    return alone.unionByName(grouped)


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without all but one row of each group of equal texts, columns unchanged.

    Rows whose length or prefix is their own pass without a shuffle. Of rows that repeat
    both id and text, the one with the smallest hash of all its columns stays.
    """
    columns = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    doc_id, text = (f"c{columns.index(c)}" for c in (doc_id, text))
    keys = surviving_keys(plain, text)
    shaped = _shaped(plain, text)
    alone = maybe_in(shaped, keys, ["_len", "_prefix"], keep=False).drop(*_OWN)
    candidates = maybe_in(shaped, keys, ["_len", "_prefix"]).withColumns(
        {"_full": _full(text), "_row": F.xxhash64(*plain.columns)}
    )
    groups = _groups(candidates, doc_id).where("_n > 1")
    # Spark may split the rows of a hot hash here: the other side has one row per hash.
    stays = F.col("_first").isNull() | (
        F.col(doc_id).eqNullSafe(F.col("_first.id")) & (F.col("_row") == F.col("_first.row"))
    )
    kept = candidates.join(groups, "_full", "left").where(stays)
    single = kept.where(F.col("_n").isNull()).drop(*_OWN)
    several = kept.where(F.col("_n").isNotNull()).dropDuplicates(["_full"]).drop(*_OWN)
    return alone.unionByName(single).unionByName(several).toDF(*columns)
