"""The whole run: bronze to silver to gold, over folders on shared storage."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import envelope, quality, sampling, state
from tidemark.operators.skew import SLICES
from tidemark.plans import marts
from tidemark.schemas import (
    CUSTOMERS,
    INGESTED,
    OFFSET,
    ORDERS,
    PARTITION,
    RAW,
    SOURCE,
    TABLES,
    TS,
)
from tidemark.session import sized_shuffles
from tidemark.sources import buckets, tables
from tidemark.streaming import jobs


def start_ingest(
    messages: DataFrame,
    bronze: str,
    checkpoints: str,
    names: Iterable[str] = tuple(TABLES),
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """One query per table, each with its own row schema, output and checkpoint."""
    return [
        jobs.ingest(
            messages, TABLES[n].row, n, f"{bronze}/{n}", f"{checkpoints}/bronze/{n}", trigger
        )
        for n in names
    ]


def bronze_tables(
    spark: SparkSession, bronze: str, names: Iterable[str] = tuple(TABLES)
) -> list[str]:
    """Those of the tables that have a log."""
    return [n for n in names if tables.exists(spark, f"{bronze}/{n}")]


def silver_tables(spark: SparkSession, silver: str) -> list[str]:
    """Those of the tables that have a current state."""
    return [
        n
        for n in TABLES
        if tables.has_versions(spark, f"{silver}/{n}") or buckets.layout(spark, f"{silver}/{n}")
    ]


def reread_bronze(
    spark: SparkSession, bronze: str, name: str, row: T.StructType | None = None
) -> DataFrame:
    """The log of a table with every message read again under its row schema of now.

    Columns that the schema has gained since a message came get their values, and messages
    that were set aside and fit now are rows.
    """
    row = row or TABLES[name].row
    path = f"{bronze}/{name}"
    good = jobs.read_bronze(spark, path, row).select(SOURCE, PARTITION, OFFSET, RAW)
    bad = jobs.read_quarantine(spark, path, row).select(SOURCE, PARTITION, OFFSET, RAW)
    return envelope.reparse(good.unionByName(bad), row, name)


def build_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    names: Iterable[str] = tuple(TABLES),
    reparse: bool = False,
    rows: dict[str, T.StructType] | None = None,
) -> dict[str, int | None]:
    """Recompute the current rows of each table; returns the version written per table.

    A table without events is skipped and keeps its old silver version. The raw message
    stays in bronze. ``reparse`` reads all messages again, which a widened row schema
    needs (``rows`` has those that differ from the declared ones) and quarantined messages
    may want.
    """
    rows = rows or {}
    written: dict[str, int | None] = {}
    for name in names:
        written[name] = None
        if not tables.exists(spark, f"{bronze}/{name}"):
            continue
        row = rows.get(name, TABLES[name].row)
        if reparse:
            events = reread_bronze(spark, bronze, name, row)
        else:
            events = jobs.read_bronze(spark, f"{bronze}/{name}", row)
        if events.isEmpty():
            continue
        with sized_shuffles(spark, tables.size(spark, f"{bronze}/{name}")):
            current = state.current_state(events.drop(RAW), TABLES[name].key)
            written[name] = tables.replace(current, f"{silver}/{name}")
    return written


def start_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    checkpoints: str,
    names: Iterable[str] = tuple(TABLES),
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """Maintain silver from new bronze rows only, one query per table.

    Use a silver folder of its own: it holds delete markers, which ``build_silver`` drops.
    """
    return [
        jobs.stream_merge(
            jobs.follow_bronze(spark, f"{bronze}/{n}", TABLES[n].row).drop(RAW),
            f"{silver}/{n}",
            f"{checkpoints}/silver/{n}",
            TABLES[n].key,
            trigger=trigger,
        )
        for n in bronze_tables(spark, bronze, names)
    ]


def compact_bronze(
    spark: SparkSession, bronze: str, before: str | None = None
) -> dict[str, list[str]]:
    """Rewrite the closed days of each log to few files; returns the days per table."""
    return {
        n: jobs.compact_log(spark, f"{bronze}/{n}", TABLES[n].row, TABLES[n].key, before)
        for n in bronze_tables(spark, bronze)
    }


def quarantined(spark: SparkSession, bronze: str) -> DataFrame:
    """How many messages each table has set aside, by reason."""
    parts = [
        jobs.read_quarantine(spark, f"{bronze}/{n}", TABLES[n].row)
        for n in bronze_tables(spark, bronze)
    ]
    if not parts:
        raise FileNotFoundError(f"no table has a log under {bronze}")
    messages = reduce(DataFrame.unionByName, parts)
    reasons = messages.groupBy(SOURCE, envelope.ERROR).agg(
        F.count(F.lit(1)).alias("messages"), F.max(INGESTED).alias("latest")
    )
    return reasons.orderBy(SOURCE, envelope.ERROR)


def read_silver(spark: SparkSession, silver: str, name: str) -> DataFrame:
    """Current rows of a table, whether rebuilt or maintained."""
    path = f"{silver}/{name}"
    kept = None if tables.has_versions(spark, path) else buckets.read_state(spark, path)
    return state.without_deletes(tables.read_current(spark, path) if kept is None else kept)


def audit_bronze(
    spark: SparkSession, bronze: str, names: Iterable[str] = tuple(TABLES)
) -> DataFrame:
    """Per table that has a log: events in, current rows, deleted keys left out."""
    parts = [
        state.audit(
            jobs.read_bronze(spark, f"{bronze}/{n}", TABLES[n].row), TABLES[n].key
        ).select(F.lit(n).alias("source_table"), "*")
        for n in bronze_tables(spark, bronze, names)
    ]
    if not parts:
        raise FileNotFoundError(f"no table has a log under {bronze}")
    return reduce(DataFrame.unionByName, parts)


# The tables that a model is made of, and the order to show its rows in.
NEEDS = {
    **{f"stg_{n}": [n] for n in TABLES},
    "fct_orders": ["orders", "order_items", "payments"],
    "dim_customers_scd2": ["customers"],
}
ORDER_BY = {
    "fct_orders": ["order_id", "payment_status", "payment_method"],
    "dim_customers_scd2": ["customer_id", "valid_from_ms"],
    **{f"stg_{n}": [t.key] for n, t in TABLES.items()},
}


def build_model(spark: SparkSession, silver: str, model: str) -> DataFrame:
    """One model; only the tables that it needs are read."""
    stg = marts.register_staging({n: read_silver(spark, silver, n) for n in NEEDS[model]})
    if model == "fct_orders":
        return marts.fct_orders(stg["orders"], stg["order_items"], stg["payments"])
    if model == "dim_customers_scd2":
        return marts.dim_customers(stg["customers"])
    return stg[NEEDS[model][0]]


def models(spark: SparkSession, silver: str) -> dict[str, DataFrame]:
    """The staging views and the marts whose tables are there, by name."""
    there = set(silver_tables(spark, silver))
    return {m: build_model(spark, silver, m) for m, needs in NEEDS.items() if there.issuperset(needs)}


def show_model(spark: SparkSession, silver: str, model: str, limit: int = 5) -> DataFrame:
    """The first rows of a model, in a fixed order."""
    return sampling.preview(build_model(spark, silver, model), ORDER_BY[model], limit)


def build_gold(spark: SparkSession, silver: str, gold: str) -> dict[str, int]:
    """Materialize the marts whose tables are there; staging models stay views."""
    there = silver_tables(spark, silver)
    with sized_shuffles(spark, sum(tables.size(spark, f"{silver}/{n}") for n in there)):
        marts_only = {n: df for n, df in models(spark, silver).items() if not n.startswith("stg_")}
        return {n: tables.replace(df, f"{gold}/{n}") for n, df in marts_only.items()}


def build_history(
    spark: SparkSession, bronze: str, gold: str, slices: int | None = SLICES
) -> int:
    """Materialize the customer dimension with all its versions, from the event log."""
    path = f"{bronze}/{CUSTOMERS.name}"
    with sized_shuffles(spark, tables.size(spark, path)):
        events = jobs.read_bronze(spark, path, CUSTOMERS.row)
        history = marts.customer_history(events, slices=slices)
        return tables.replace(history, f"{gold}/dim_customers_history")


def check_silver(spark: SparkSession, silver: str, bronze: str | None = None) -> DataFrame:
    """The gate report over silver: every declared constraint of the tables that are there.

    With ``bronze`` the status chain of the order events is checked too. Pass the
    report through ``quality.collected`` to work it out once, and to ``quality.enforce`` to
    stop the run if a check failed.
    """
    there = silver_tables(spark, silver)
    data = {n: read_silver(spark, silver, n) for n in there}
    report = []
    for n in there:
        table = TABLES[n]
        report.append(quality.summarize(data[n], quality.row_rules(table, data[n].columns), n))
        for col in table.unique:
            report.append(quality.summarize_unique(data[n], col, f"{n}.unique:{col}"))
        for col, (parent, parent_key) in table.foreign_keys.items():
            if parent in data:
                check = f"{n}.foreign_key:{col}"
                report.append(
                    quality.summarize_foreign_key(data[n], col, data[parent], parent_key, check)
                )
    if {"payments", "order_items"} <= data.keys():
        totals = marts.order_totals(data["order_items"])
        bad = quality.check_amounts(data["payments"], totals)
        report.append(
            quality.count_violations(data["payments"], bad, "payments.amount_is_item_total")
        )
    if {"payments", "orders"} <= data.keys():
        bad = quality.check_paid(data["orders"], data["payments"])
        report.append(quality.count_violations(data["orders"], bad, "orders.paid_has_payment"))
    if bronze and tables.exists(spark, f"{bronze}/orders"):
        events = jobs.read_bronze(spark, f"{bronze}/orders", ORDERS.row)
        bad = check_order_statuses(spark, bronze)
        report.append(quality.count_violations(events, bad, "orders.status_chain"))
    if not report:
        raise FileNotFoundError(f"no table has a state under {silver}")
    return quality.gate(report)


def check_order_statuses(spark: SparkSession, bronze: str) -> DataFrame:
    """Order events that break the status chain, from the event log."""
    events = jobs.read_bronze(spark, f"{bronze}/orders", ORDERS.row)
    return quality.check_transitions(events, "order_id").select(
        "order_id", TS, PARTITION, OFFSET, "previous", "order_status"
    )
