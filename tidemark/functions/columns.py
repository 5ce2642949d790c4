"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def names(cols: str | Sequence[str]) -> list[str]:
    """A list of column names from one name or several."""
    return [cols] if isinstance(cols, str) else list(cols)


def position(ts: str, seq: str | Sequence[str]) -> Column:
    """Place of an event in its key's order: source time, then topic position.

    An event without a time sorts after every dated one, as it does in a sort with
    nulls last. Structs compare field by field, so the result can be ordered,
    compared and given to ``max_by``.
    """
    return F.struct(
        F.col(ts).isNull().alias("undated"),
        F.col(ts).alias("ts"),
        *[F.col(s).alias(f"seq{i}") for i, s in enumerate(names(seq))],
    )


def oldest_first(ts: str, seq: str | Sequence[str]) -> list[Column]:
    return [F.col(ts).asc_nulls_last(), *[F.col(s).asc() for s in names(seq)]]


def newest_first(ts: str, seq: str | Sequence[str]) -> list[Column]:
    return [F.col(ts).desc_nulls_first(), *[F.col(s).desc() for s in names(seq)]]


def is_delete(op: str) -> Column:
    """True for a delete event; an event without an op is not one."""
    return F.col(op).eqNullSafe("d")


def utc_iso(instant: Column) -> Column:
    """ISO-8601 text of an instant. The session time zone is UTC."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")

