"""Limits and samples with a fixed result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import names


def preview(df: DataFrame, order: str | Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``order``; a distributed top-n, not a full sort."""
    return df.orderBy(*names(order)).limit(n)


def sample_rows(df: DataFrame, key: str | Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` rows in an order scrambled by ``seed``: the same sample on every run."""
    keys = names(key)
    scrambled = F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return df.orderBy(scrambled, *keys).limit(n)
