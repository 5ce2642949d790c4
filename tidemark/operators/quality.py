"""Data-quality checks. Each check returns the violating rows or keys."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import names
from tidemark.operators.history import with_previous
from tidemark.operators.skew import SLICES
from tidemark.schemas import ORDER_STATUSES, SEQ, TS, Table


def null_rule(col: str) -> Column:
    return F.col(col).isNull()


def length_rule(col: str, limit: int) -> Column:
    return F.length(col) > limit


def money_rule(col: str) -> Column:
    """True for a value that NUMERIC(10,2) cannot hold exactly."""
    value = F.col(col).cast("double")
    cents = F.rint(value * 100)
    fits = (F.abs(cents) < 1e10) & (cents / 100 == value)
    return F.col(col).isNotNull() & ~fits


def accepted_rule(col: str, accepted: Sequence[str]) -> Column:
    """True for a value outside the domain; null is not judged here."""
    return F.coalesce(~F.col(col).isin(*accepted), F.lit(False))


def row_rules(table: Table, columns: Iterable[str]) -> dict[str, Column]:
    """The row-level rules of a table for the ``columns`` at hand, by check name."""
    have = set(columns)
    rules: dict[str, Column] = {}
    for c in table.not_null:
        rules[f"not_null:{c}"] = null_rule(c)
    for c, limit in table.max_length.items():
        rules[f"length:{c}"] = length_rule(c, limit)
    for c in table.money:
        rules[f"decimal:{c}"] = money_rule(c)
    for c, accepted in table.accepted.items():
        rules[f"accepted:{c}"] = accepted_rule(c, accepted)
    return {name: rule for name, rule in rules.items() if name.split(":")[1] in have}


def violations(df: DataFrame, rules: dict[str, Column], keep: Sequence[str]) -> DataFrame:
    """One row per broken rule: the ``keep`` columns and ``check``. One pass, no shuffle."""
    broken = F.array_compact(F.array(*[F.when(rule, name) for name, rule in rules.items()]))
    return df.select(*keep, F.explode(broken).alias("check"))


def check_not_null(df: DataFrame, key: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    return violations(df, {f"not_null:{c}": null_rule(c) for c in cols}, names(key))


def check_length(df: DataFrame, key: str | Sequence[str], limits: dict[str, int]) -> DataFrame:
    return violations(df, {f"length:{c}": length_rule(c, n) for c, n in limits.items()}, names(key))


def check_decimal(df: DataFrame, key: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    return violations(df, {f"decimal:{c}": money_rule(c) for c in cols}, names(key))


def check_accepted(
    df: DataFrame, key: str | Sequence[str], domains: dict[str, Sequence[str]]
) -> DataFrame:
    rules = {f"accepted:{c}": accepted_rule(c, v) for c, v in domains.items()}
    return violations(df, rules, names(key))


def check_unique(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Values that occur more than once, with their count. Nulls are not counted."""
    cols = names(cols)
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    counts = df.where(present).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > 1)


def check_foreign_key(
    child: DataFrame, col: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Child rows whose reference is set and has no parent."""
    known = parent.select(F.col(parent_key).alias(col))
    return child.where(F.col(col).isNotNull()).join(known, col, "left_anti").select(*child.columns)


def check_transitions(
    events: DataFrame,
    keys: str | Sequence[str],
    col: str = "order_status",
    ts: str = TS,
    seq: str | Sequence[str] = SEQ,
    chain: Sequence[str] = ORDER_STATUSES,
    slices: int | None = SLICES,
) -> DataFrame:
    """Events whose status is not one step along the chain from the one before.

    A first event, and one that repeats the status, pass.
    """
    steps = [F.struct(F.lit(a), F.lit(b)) for a, b in zip(chain, chain[1:])]
    step = F.struct(F.col("previous"), F.col(col))
    judged = with_previous(events, keys, col, ts, seq, slices)
    moved = F.col("previous").isNotNull() & ~F.col(col).eqNullSafe(F.col("previous"))
    return judged.where(moved & ~F.coalesce(step.isin(*steps), F.lit(False)))


def check_amounts(payments: DataFrame, order_totals: DataFrame) -> DataFrame:
    """Payments whose amount is not the order's rounded item total."""
    totals = order_totals.select("order_id", F.round("order_revenue", 2).alias("expected"))
    joined = payments.join(totals, "order_id", "left")
    return joined.where(~F.col("amount").cast("double").eqNullSafe(F.col("expected")))


def check_paid(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders at PAID or later without a SUCCESS payment that has a time."""
    paid = payments.where(
        (F.col("payment_status") == "SUCCESS") & F.col("paid_at").isNotNull()
    ).select("order_id")
    due = orders.where(F.col("order_status").isin(*ORDER_STATUSES[1:]))
    return due.join(paid, "order_id", "left_anti")


def summarize(df: DataFrame, rules: dict[str, Column], table: str) -> DataFrame:
    """All row-level rules of a table in one pass: check, rows_checked, rows_failed."""
    counts = [F.count_if(rule).alias(f"_f{i}") for i, rule in enumerate(rules.values())]
    one_row = df.agg(F.count(F.lit(1)).alias("_n"), *counts)
    results = F.array(
        *[
            F.struct(F.lit(f"{table}.{name}").alias("check"), F.col(f"_f{i}").alias("failed"))
            for i, name in enumerate(rules)
        ]
    )
    return one_row.select("_n", F.explode(results).alias("_r")).select(
        F.col("_r.check").alias("check"),
        F.col("_n").alias("rows_checked"),
        F.col("_r.failed").alias("rows_failed"),
    )


def count_violations(checked: DataFrame, failed: DataFrame, check: str) -> DataFrame:
    """A set-level check as one row: check, rows_checked, rows_failed."""
    one, zero = F.lit(1).alias("c"), F.lit(0).alias("f")
    both = checked.select(one, zero).unionAll(failed.select(F.lit(0), F.lit(1)))
    return both.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("rows_checked"),
        F.coalesce(F.sum("f"), F.lit(0)).alias("rows_failed"),
    ).select(F.lit(check).alias("check"), "rows_checked", "rows_failed")


def _one_row(counted: DataFrame, check: str) -> DataFrame:
    return counted.select(
        F.lit(check).alias("check"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("rows_checked", "rows_failed")],
    )


def summarize_unique(df: DataFrame, cols: str | Sequence[str], check: str) -> DataFrame:
    """``check_unique`` as one row, in the pass that groups the values: values that repeat."""
    cols = names(cols)
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return _one_row(
        groups.agg(
            F.sum("_n").alias("rows_checked"), F.count_if(present & (F.col("_n") > 1)).alias("rows_failed")
        ),
        check,
    )


def summarize_foreign_key(
    child: DataFrame, col: str, parent: DataFrame, parent_key: str, check: str
) -> DataFrame:
    """``check_foreign_key`` as one row: child rows are counted per reference before they meet
    their parents."""
    references = child.groupBy(F.col(col).alias("_ref")).agg(F.count(F.lit(1)).alias("_n"))
    known = parent.select(F.col(parent_key).alias("_ref")).distinct().withColumn("_known", F.lit(True))
    lost = F.col("_known").isNull() & F.col("_ref").isNotNull()
    return _one_row(
        references.join(known, "_ref", "left").agg(
            F.sum("_n").alias("rows_checked"), F.sum(F.when(lost, F.col("_n"))).alias("rows_failed")
        ),
        check,
    )


def gate(summaries: Sequence[DataFrame]) -> DataFrame:
    """The summaries as one report with ``passed``."""
    report = reduce(DataFrame.unionByName, summaries)
    return report.withColumn("passed", F.col("rows_failed") == 0)


def collected(report: DataFrame) -> DataFrame:
    """The report worked out once, as a short local table in the order of its checks."""
    rows = report.orderBy("check").collect()
    return report.sparkSession.createDataFrame(rows, report.schema)


class GateFailed(Exception):
    """Raised by ``enforce``; carries the names of the failed checks."""


def enforce(report: DataFrame) -> None:
    """Stop the run if any check of a gate report failed."""
    failed = report.where(~F.col("passed")).orderBy("check").collect()
    if failed:
        lines = [f"{r['check']}: {r['rows_failed']} of {r['rows_checked']}" for r in failed]
        raise GateFailed("; ".join(lines))
