"""Current state from an event log: latest event per key, as-of, merge, audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import is_delete, names, newest_first, position
from tidemark.schemas import OP, SEQ, TS


def latest_per_key(
    df: DataFrame, keys: str | Sequence[str], ts: str = TS, seq: str | Sequence[str] = SEQ
) -> DataFrame:
    """The newest event of each key, deletes included.

    Order is source time, then sequence; arrival order and redelivered copies do not
    matter. Spark limits each key to one row per task before the shuffle, so a heavy key
    costs no more than any other.
    """
    newest = Window.partitionBy(*names(keys)).orderBy(*newest_first(ts, seq))
    return df.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


def current_state(
    events: DataFrame,
    keys: str | Sequence[str],
    ts: str = TS,
    seq: str | Sequence[str] = SEQ,
    op: str = OP,
    as_of: int | None = None,
) -> DataFrame:
    """Rows that exist now, or existed at ``as_of`` (epoch ms, inclusive).

    An event without a time is in no past state: its place in time is unknown.
    """
    if as_of is not None:
        events = events.where(F.col(ts) <= as_of)
    return without_deletes(latest_per_key(events, keys, ts, seq), op)


def without_deletes(state: DataFrame, op: str = OP) -> DataFrame:
    """The rows of a latest-per-key state whose last event is not a delete."""
    return state.where(~is_delete(op))


def deleted_keys(
    events: DataFrame,
    keys: str | Sequence[str],
    ts: str = TS,
    seq: str | Sequence[str] = SEQ,
    op: str = OP,
) -> DataFrame:
    """Keys whose last event is a delete."""
    narrow = events.select(*names(keys), ts, *names(seq), op)
    return latest_per_key(narrow, keys, ts, seq).where(is_delete(op)).select(*names(keys))


def merge_changes(
    state: DataFrame,
    events: DataFrame,
    keys: str | Sequence[str],
    ts: str = TS,
    seq: str | Sequence[str] = SEQ,
) -> DataFrame:
    """State after ``events``. Deletes stay as markers, so a late older event of a
    deleted key cannot bring it back; read the result through ``without_deletes``.
    """
    together = state.unionByName(events, allowMissingColumns=True)
    return latest_per_key(together, keys, ts, seq)


def audit(
    events: DataFrame,
    keys: str | Sequence[str],
    ts: str = TS,
    seq: str | Sequence[str] = SEQ,
    op: str = OP,
) -> DataFrame:
    """One row: events in, rows in the current state, deleted keys left out."""
    per_key = events.groupBy(*names(keys)).agg(
        F.count(F.lit(1)).alias("_n"), F.max_by(op, position(ts, seq)).alias("_last_op")
    )
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("events_in"),
        F.count_if(~is_delete("_last_op")).alias("current_rows"),
        F.count_if(is_delete("_last_op")).alias("deleted_keys"),
    )
