"""Staging views and marts over the silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import names
from tidemark.operators.history import scd2, validity
from tidemark.operators.skew import SLICES
from tidemark.operators.state import latest_per_key
from tidemark.schemas import SEQ, TS, Table

CUSTOMER_COLUMNS = ["full_name", "email", "country"]


def register_staging(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """A view ``stg_<table>`` over each silver table; returns the views by table."""
    for table, df in silver.items():
        df.createOrReplaceTempView(f"stg_{table}")
    return {t: df.sparkSession.table(f"stg_{t}") for t, df in silver.items()}


def typed(df: DataFrame, table: Table) -> DataFrame:
    """A silver table with the source's types: money as decimal, times as timestamps.

    Money that the source type cannot hold reads as null; the decimal check finds it.
    """
    columns = {c: F.col(c).try_cast("decimal(10,2)") for c in table.money if c in df.columns}
    columns |= {c: F.timestamp_micros(c) for c in table.times if c in df.columns}
    return df.withColumns(columns)


def order_totals(order_items: DataFrame) -> DataFrame:
    """Revenue and item count per order.

    Prices are summed as decimals of six places, so a sum depends neither on the order of
    rows nor on rounding to cents. A price that is no such number (NaN, or too large for
    22 digits) counts as missing; an order whose sum is too large has no revenue. The
    decimal check reports such prices.
    """
    price = F.col("unit_price").try_cast("decimal(28,6)")
    amount = F.try_multiply(F.col("quantity").cast("decimal(10,0)"), price)
    return order_items.groupBy("order_id").agg(
        F.try_sum(amount).cast("double").alias("order_revenue"),
        F.sum("quantity").alias("total_items"),
    )


def fct_orders(
    orders: DataFrame,
    order_items: DataFrame,
    payments: DataFrame,
    latest_payment: bool = False,
    payment_order: str | list[str] = "payment_id",
) -> DataFrame:
    """The order fact: one row per order and payment, orders without either included.

    Several payments of an order repeat its revenue. ``latest_payment`` keeps the newest
    one by ``payment_order`` instead, for one row per order.
    """
    rows = orders.select("order_id", "customer_id", "order_status", "order_date")
    facts = rows.join(order_totals(order_items), "order_id", "left")
    if latest_payment:
        first, *rest = names(payment_order)
        newest = payments.select(
            "order_id", "payment_status", "payment_method", *[first, *rest]
        )
        newest = latest_per_key(newest, "order_id", first, rest)
        joined = facts.join(newest, "order_id", "left")
    else:
        narrow = payments.select("order_id", "payment_status", "payment_method")
        # A left join could not split the payments of one order over tasks; these joins can.
        # Both read the same facts, without null keys, so their shuffles are made once.
        facts = facts.where("order_id IS NOT NULL")
        unpaid = facts.join(narrow.select("order_id"), "order_id", "left_anti")
        joined = (
            facts.join(narrow, "order_id")
            .unionByName(unpaid, allowMissingColumns=True)
            .unionByName(rows.where("order_id IS NULL"), allowMissingColumns=True)
        )
    return joined.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_date",
        "order_revenue",
        "total_items",
        "payment_status",
        "payment_method",
    )


def dim_customers(customers: DataFrame) -> DataFrame:
    """The customer dimension over silver: one open version per customer."""
    return validity(customers, "customer_id", CUSTOMER_COLUMNS, TS)


def customer_history(
    events: DataFrame,
    seq: str | list[str] | tuple[str, ...] = SEQ,
    slices: int | None = SLICES,
) -> DataFrame:
    """The customer dimension over the event log: a row per version, deleted ones included.

    A repeated snapshot of an unchanged customer opens no version.
    """
    return scd2(events, "customer_id", CUSTOMER_COLUMNS, TS, seq, compact=True, slices=slices)
