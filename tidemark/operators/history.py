"""History over an event log: validity intervals, transitions, event order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import is_delete, names
from tidemark.operators.skew import SLICES, Cuts, by_heat, neighbour, ordinal
from tidemark.schemas import OP, SEQ, TS


def _interval(
    keys: list[str], tracked: list[str], ts: str, until: Column, current: Column
) -> list[Column]:
    """The columns of a version; it is current if no event comes after, dated or not."""
    return [
        *[F.col(c) for c in [*keys, *tracked]],
        F.col(ts).alias("valid_from_ms"),
        until.alias("valid_to_ms"),
        current.alias("is_current"),
    ]


def validity(
    state: DataFrame, keys: str | Sequence[str], tracked: Sequence[str], ts: str = TS
) -> DataFrame:
    """Interval columns over a current state: ``LEAD`` of the time per key.

    With one row per key every version is open. For the versions of a whole log use
    ``scd2``, which also copes with keys that have very many events.
    """
    keys = names(keys)
    w = Window.partitionBy(*keys).orderBy(F.col(ts).asc_nulls_last())
    later = {"_until": F.lead(ts).over(w), "_last": F.lead(F.lit(True)).over(w).isNull()}
    return state.withColumns(later).select(
        *_interval(keys, list(tracked), ts, F.col("_until"), F.col("_last"))
    )


def scd2(
    events: DataFrame,
    keys: str | Sequence[str],
    tracked: Sequence[str],
    ts: str = TS,
    seq: str | Sequence[str] = SEQ,
    op: str = OP,
    compact: bool = False,
    slices: int | None = SLICES,
) -> DataFrame:
    """One row per version of each key, valid in [valid_from_ms, valid_to_ms).

    A delete closes the open version and opens none. With ``compact`` an event that
    changes none of the ``tracked`` columns (a repeated snapshot) opens no version. An
    event without a time is the last of its key; the version before it then has no end
    but is not current. Keys with very many events are dealt over tasks by ``slices``, see ``skew``.
    """
    keys, tracked = names(keys), list(tracked)
    carried = dict.fromkeys([*keys, ts, *names(seq), op, *tracked])
    log = events.select(*carried)
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.col(f"_before.{c}"))
    unchanged = F.col("_before").isNotNull() & ~is_delete(f"_before.{op}") & same

    def versions(log: DataFrame, cuts: Cuts | None) -> DataFrame:
        if compact:
            log = neighbour(log, keys, ts, seq, [op, *tracked], -1, "_before", cuts)
            log = log.where(is_delete(op) | ~unchanged).drop("_before")
        return neighbour(log, keys, ts, seq, ts, 1, "_after", cuts)

    return by_heat(log, keys, ts, versions, slices).where(~is_delete(op)).select(
        *_interval(keys, tracked, ts, F.col(f"_after.{ts}"), F.col("_after").isNull())
    )


def with_previous(
    events: DataFrame,
    keys: str | Sequence[str],
    col: str,
    ts: str = TS,
    seq: str | Sequence[str] = SEQ,
    slices: int | None = SLICES,
) -> DataFrame:
    """Events with ``previous``: the value of ``col`` at the key's event before."""

    def found(rows: DataFrame, cuts: Cuts | None) -> DataFrame:
        return neighbour(rows, keys, ts, seq, col, -1, "_before", cuts)

    return by_heat(events, keys, ts, found, slices).select(*events.columns, F.col(f"_before.{col}").alias("previous"))


def transitions(
    events: DataFrame,
    keys: str | Sequence[str],
    col: str,
    ts: str = TS,
    seq: str | Sequence[str] = SEQ,
    slices: int | None = SLICES,
) -> DataFrame:
    """How often each value of ``col`` follows each other one; null before the first."""
    narrow = events.select(*dict.fromkeys([*names(keys), ts, *names(seq), col]))
    return (
        with_previous(narrow, keys, col, ts, seq, slices)
        .groupBy("previous", F.col(col).alias("next"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def event_order(
    events: DataFrame,
    keys: str | Sequence[str],
    ts: str = TS,
    seq: str | Sequence[str] = SEQ,
    slices: int | None = SLICES,
) -> DataFrame:
    """Events with ``event_no``: 1, 2, ... in each key's order, times without value last."""

    def placed(rows: DataFrame, cuts: Cuts | None) -> DataFrame:
        return ordinal(rows, keys, ts, seq, "event_no", cuts)

    return by_heat(events, keys, ts, placed, slices)
