"""Windows over the events of a key, with the events of hot keys dealt over many tasks.

A window sends all events of a key to one task. A key that has more than its share of all
events is cut into slices of time instead, and a task holds a key's events of one slice. One
scan finds both: the hot keys by a sketch of frequent items, and cut points of equal depth by a
sketch of quantiles, so a slice holds a fixed share of the events however they crowd in time.
A time that is a cut point has a slice of its own, cut further by sequence; so have events
without a time, which come last. One small row per hot key and slice carries what the next or
the one before needs to know, and is shuffled with the events. All other keys go another
way, whole and without such rows. Results are the same wherever the cuts fall.

Both sketches are a scalar subquery of the plan: building a frame starts no job, and neither
keys nor cuts come to the driver. Copies of an event (same key, time and sequence) must be
equal in all columns; they are collapsed to one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import names, oldest_first, position

SLICE, _EDGE, _NEAR = "_slice", "_edge", "_near"

# Slices of equal depth. A key with more than one such share of all events is hot, so there are
# fewer hot keys than slices.
SLICES = 256

# Sequence numbers of one slice among events of one time, or of none.
_SEQ_BLOCK = 1 << 20


def _cuts(events: DataFrame, keys: list[str], ts: str, slices: int) -> Column:
    """Hashes of the hot keys and the cut points of time, as a subquery of one row."""
    shares = [i / slices for i in range(1, slices)]
    found = events.select(F.xxhash64(*keys).alias("key"), F.col(ts).cast("bigint").alias("ts")).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(key, {slices})").alias("top"),
        F.percentile_approx("ts", shares).alias("cuts"),
    )
    hot = F.filter("top", lambda k: k["count"] * slices > F.col("n"))
    return found.select(
        F.struct(
            F.transform(hot, lambda k: k["item"]).alias("hot"),
            F.array_sort(F.array_distinct(F.coalesce("cuts", F.array().cast("array<bigint>")))).alias("at"),
        )
    ).scalar()


@dataclass(frozen=True)
class Cuts:
    """Cut points of time, ascending, and the number of slices that they are for."""

    at: Column
    slices: int


def _sliced(events: DataFrame, ts: str, seq: str | Sequence[str], cuts: Cuts) -> DataFrame:
    """Events with their slice; slices sort as the events in them do."""
    *first, last = names(seq)
    t, at = F.col(ts).cast("bigint"), F.col("_cuts")
    steps = [1 << b for b in reversed(range(cuts.slices.bit_length()))]
    # Binary search: how many cut points are no later than the event.
    below = F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda i, s: F.when(F.coalesce(F.get(at, i + s - 1) <= t, F.lit(False)), i + s).otherwise(i),
    )
    undated, none = F.col(ts).isNull(), F.lit(0).cast("bigint")
    placed = F.struct(below.alias("below"), F.get(at, below - 1).eqNullSafe(t).alias("at"))
    one_time = undated | placed["at"]
    found = F.struct(
        undated.alias("undated"),
        F.when(undated, 0).otherwise(placed["below"]).alias("below"),
        (~one_time).alias("between"),
        *[F.when(one_time, F.col(s).cast("bigint")).otherwise(none).alias(f"seq{i}") for i, s in enumerate(first)],
        F.when(one_time, F.floor(F.col(last) / _SEQ_BLOCK)).otherwise(none).alias("block"),
    )
    return events.withColumn("_cuts", cuts.at).withColumn(SLICE, found).drop("_cuts")


def by_heat(
    events: DataFrame,
    keys: str | Sequence[str],
    ts: str,
    work: Callable[[DataFrame, Cuts | None], DataFrame],
    slices: int | None = SLICES,
) -> DataFrame:
    """``work`` done on the events of ordinary keys, and with cut points on those of hot keys.

    So ordinary keys are shuffled as if there were no others. ``slices=None`` takes all keys
    for ordinary ones.
    """
    if slices is None:
        return work(events, None)
    keys = names(keys)
    cuts = _cuts(events, keys, ts, slices)
    hot = F.coalesce(F.array_contains(cuts["hot"], F.xxhash64(*keys)), F.lit(False))
    ordinary = work(events.where(~hot), None)
    return ordinary.unionByName(work(events.where(hot), Cuts(cuts["at"], slices)))


def _near(col: str) -> str:
    return f"{_NEAR}_{col}"


def _beside(
    rows: DataFrame,
    by: list[str],
    ts: str,
    seq: str | Sequence[str],
    values: Sequence[str],
    step: int,
    *more: Column,
) -> DataFrame:
    """Add the values of the row beside each one, and drop rows that are copies of it.

    Column by column: a struct would be built, and shuffled, in addition to its columns.
    ``more`` are ranks to add over the same window.
    """
    window = Window.partitionBy(*by).orderBy(*oldest_first(ts, seq))
    beside = F.lead if step > 0 else F.lag
    order = [ts, *names(seq)]
    added = {_near(c): beside(c).over(window) for c in dict.fromkeys([*order, *values])}
    added |= {f"_more{i}": m.over(window) for i, m in enumerate(more)}
    copy = reduce(and_, [F.col(c).eqNullSafe(F.col(_near(c))) for c in order])
    found = rows.withColumns({_NEAR: beside(F.lit(True)).over(window), **added})
    return found.where(F.col(_NEAR).isNull() | ~copy)


def _with_edges(
    events: DataFrame,
    keys: list[str],
    ts: str,
    seq: str | Sequence[str],
    values: Sequence[str],
    step: int,
    cuts: Cuts,
) -> DataFrame:
    """Events with their slice, and in each slice the event beside it in the next one.

    For step 1 that is the first event of the slice after, for -1 the last of the one
    before. In its order it comes after, or before, all events of the slice.
    """
    marked = _sliced(events, ts, seq, cuts)
    row = F.struct(*dict.fromkeys([ts, *names(seq), *values]))
    place = position(ts, seq)
    edge = F.min_by(row, place) if step > 0 else F.max_by(row, place)
    across = Window.partitionBy(*keys).orderBy(SLICE)
    beyond = F.lead(_EDGE) if step > 0 else F.lag(_EDGE)
    edges = (
        marked.groupBy(*keys, SLICE)
        .agg(edge.alias(_EDGE))
        .select(*keys, SLICE, beyond.over(across).alias("_beyond"))
        .where(F.col("_beyond").isNotNull())
        .select(*keys, SLICE, "_beyond.*", F.lit(True).alias(_EDGE))
    )
    return marked.withColumn(_EDGE, F.lit(False)).unionByName(edges, allowMissingColumns=True)


def neighbour(
    events: DataFrame,
    keys: str | Sequence[str],
    ts: str,
    seq: str | Sequence[str],
    values: str | Sequence[str],
    step: int,
    name: str,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Add ``name``: the ``values`` of the key's next (step 1) or previous (-1) event.

    ``name`` is a struct, null where there is no such event. Copies of an event are
    collapsed to one row. Without ``cuts`` all events of a key are in one task.
    """
    keys, values = names(keys), names(values)
    found = F.struct(*[F.col(_near(v)).alias(v) for v in values])
    if cuts is None:
        rows = _beside(events, keys, ts, seq, values, step)
    else:
        cut = _with_edges(events, keys, ts, seq, values, step, cuts)
        rows = _beside(cut, [*keys, SLICE], ts, seq, values, step).where(~F.col(_EDGE))
    return rows.select(*events.columns, F.when(F.col(_NEAR), found).alias(name))


def ordinal(
    events: DataFrame,
    keys: str | Sequence[str],
    ts: str,
    seq: str | Sequence[str],
    name: str,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Add ``name``: the place of each event in its key's order, from 1; copies collapse."""
    keys = names(keys)
    if cuts is None:
        ranked = _beside(events, keys, ts, seq, [], -1, F.dense_rank())
        return ranked.select(*events.columns, F.col("_more0").cast("bigint").alias(name))
    marked = _sliced(events, ts, seq, cuts)
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        marked.groupBy(*keys, SLICE)
        .agg(F.count_distinct(F.struct(ts, *names(seq))).alias("_n"))
        .select(*keys, SLICE, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_earlier"))
    )
    # The count of earlier events is one more row of the slice, its first.
    rows = marked.withColumn("_earlier", F.lit(None).cast("bigint")).unionByName(
        counts.withColumn(_EDGE, F.lit(True)), allowMissingColumns=True
    )
    by = Window.partitionBy(*keys, SLICE)
    whole = rows.withColumn("_earlier", F.max("_earlier").over(by))
    inside = by.orderBy(F.col(_EDGE).desc_nulls_last(), *oldest_first(ts, seq))
    order = [ts, *names(seq)]
    placed = whole.withColumns(
        {
            "_rank": F.dense_rank().over(inside),
            "_event": F.lag(F.col(_EDGE).isNull()).over(inside),
            **{_near(c): F.lag(c).over(inside) for c in order},
        }
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(_near(c))) for c in order])
    copy = F.coalesce("_event", F.lit(False)) & same
    number = F.col("_rank") + F.coalesce(F.col("_earlier") - 1, F.lit(0))
    return placed.where(F.col(_EDGE).isNull() & ~copy).select(
        *events.columns, number.cast("bigint").alias(name)
    )
