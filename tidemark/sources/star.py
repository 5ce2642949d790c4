"""Source tables and change logs derived from a star schema of Parquet files.

``star.<table>(spark, folder)`` reads ``<folder>/<file>.parquet`` and shapes it as one of
the declared source tables, or as a change log over it. Every frame covers its whole file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import is_delete
from tidemark.operators.capture import envelope_json, to_envelopes
from tidemark.schemas import OP, ORDER_STATUSES, TOPIC_PREFIX, TS, Table, row_schema

DAY_MS = 86_400_000


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def micros(col: str) -> Column:
    """Epoch microseconds of a wall-clock time; the session time zone is UTC."""
    return F.unix_micros(F.col(col).cast("timestamp"))


def millis(col: str) -> Column:
    return F.expr(f"unix_micros(cast({col} as timestamp)) div 1000")


def _status(col: str) -> Column:
    return (
        F.when(F.col(col) == "O", "PENDING").when(F.col(col) == "P", "PAID").otherwise("DELIVERED")
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nation = read(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    return (
        read(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("full_name"),
            F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias(
                "email"
            ),
            "country",
            "c_acctbal",
            "c_mktsegment",
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("stock_quantity"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _status("o_orderstatus").alias("order_status"),
        micros("o_orderdate").alias("order_date"),
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    """One payment per order, and a second one for urgent orders, so that facts fan out."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    settled = F.col("o_orderstatus") != "O"
    method = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "credit_card")
        .when(F.col("o_orderpriority") == "2-HIGH", "debit_card")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "paypal")
        .otherwise("wallet")
    )
    attempts = F.when(urgent, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        read(spark, folder, "orders")
        .withColumn("attempt", F.explode(attempts))
        .select(
            (F.col("o_orderkey") * 2 + F.col("attempt")).alias("payment_id"),
            F.col("o_orderkey").alias("order_id"),
            F.when(settled, "SUCCESS").otherwise("INITIATED").alias("payment_status"),
            F.when(F.col("attempt") == 0, method).otherwise("wallet").alias("payment_method"),
            F.col("o_totalprice").alias("amount"),
            F.when(settled, micros("o_orderdate")).alias("paid_at"),
            micros("o_orderdate").alias("updated_at"),
        )
    )


def user_log(events: DataFrame) -> DataFrame:
    """The events table, batch or stream, as a change log of users.

    ``event_id`` is the sequence. An ``error`` deletes the user, a ``signup`` creates it.
    """
    return events.select(
        "user_id",
        "event_id",
        millis("ts").alias(TS),
        F.when(F.col("event_type") == "error", "d")
        .when(F.col("event_type") == "signup", "c")
        .otherwise("u")
        .alias(OP),
        "event_type",
        "value",
        "props",
    )


def user_changes(spark: SparkSession, folder: str) -> DataFrame:
    return user_log(read(spark, folder, "events"))


USER_ROW = row_schema("user_id bigint, event_type string, value double, props string")


def user_messages(events: DataFrame) -> DataFrame:
    """The events table, batch or stream, as the messages of a topic ``users``.

    Creates and deletes come wrapped, updates plain. A delete carries the old image and a
    tombstone follows it. Clicks worth more than 100 are cut off and cannot be read.
    """
    row = F.struct(*USER_ROW.fieldNames())
    deleted = is_delete("op")
    cut_off = (F.col("event_type") == "click") & (F.col("value") > 100)
    text = F.when(cut_off, F.left("_text", F.length("_text") - 9)).otherwise(F.col("_text"))
    value = text.cast("binary")
    return (
        user_log(events)
        .withColumnsRenamed({OP: "op", TS: "ts_ms"})
        .withColumn("before", F.when(deleted, row))
        .withColumn("after", F.when(~deleted, row))
        .withColumn("_text", envelope_json(F.col("op").isin("c", "d")))
        .select("event_id", value.alias("value"), deleted.alias("deleted"))
        .select(
            "event_id",
            F.posexplode(
                F.when(F.col("deleted"), F.array("value", F.lit(None))).otherwise(F.array("value"))
            ),
        )
        .select(
            F.lit(TOPIC_PREFIX + "users").alias("topic"),
            F.lit(0).alias("partition"),
            (F.col("event_id") * 2 + F.col("pos")).alias("offset"),
            F.col("col").alias("value"),
        )
    )


def log_messages(log: DataFrame, table: Table) -> DataFrame:
    """A change log as the messages of its topic, with the columns it has of the row."""
    row = F.struct(*[c for c in table.row.fieldNames() if c in log.columns])
    deleted = is_delete("op")
    events = log.withColumnsRenamed({OP: "op", TS: "ts_ms"}).select(
        "op",
        "ts_ms",
        F.when(deleted, row).alias("before"),
        F.when(~deleted, row).alias("after"),
        "seq",
    )
    return to_envelopes(events, table.name, F.col("seq"))


def customer_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshot of all customers; then one segment moves and indebted ones of another go."""
    moved = F.col("c_mktsegment") == "BUILDING"
    gone = (F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") < 0)
    ops = (
        F.when(moved, F.array(F.lit("r"), F.lit("u")))
        .when(gone, F.array(F.lit("r"), F.lit("d")))
        .otherwise(F.array(F.lit("r"), F.lit("r")))
    )
    country = F.when(F.col(OP) == "u", F.lit("MOVED")).otherwise(F.col("country"))
    return (
        customers(spark, folder)
        .select("*", F.posexplode(ops).alias("seq", OP))
        .select(
            "customer_id",
            "full_name",
            "email",
            country.alias("country"),
            OP,
            (F.col("seq") * DAY_MS).cast("bigint").alias(TS),
            "seq",
        )
    )


def order_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The life of every order: one event a day until it has its status."""
    chain = (
        F.when(F.col("order_status") == "PENDING", F.array(F.lit("PENDING")))
        .when(F.col("order_status") == "PAID", F.array(F.lit("PENDING"), F.lit("PAID")))
        .otherwise(F.array(*[F.lit(s) for s in ORDER_STATUSES[:4]]))
    )
    return (
        orders(spark, folder)
        .select("order_id", "customer_id", "order_date", F.posexplode(chain).alias("seq", "order_status"))
        .select(
            "order_id",
            "customer_id",
            "order_status",
            "order_date",
            F.when(F.col("seq") == 0, "c").otherwise("u").alias(OP),
            F.expr(f"order_date div 1000 + seq * {DAY_MS}").alias(TS),
            "seq",
        )
    )


def order_item_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as creations at their ship date; a repeated item number is an update."""
    return read(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.lit("c").alias(OP),
        millis("l_shipdate").alias(TS),
        F.col("l_partkey").alias("seq"),
    )


def payment_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Payments created at order time; settled ones are updated a day later."""
    started = F.struct(F.lit("c").alias("op"), F.lit("INITIATED").alias("status"))
    settled = F.struct(F.lit("u").alias("op"), F.lit("SUCCESS").alias("status"))
    steps = F.when(F.col("paid_at").isNotNull(), F.array(started, settled)).otherwise(
        F.array(started)
    )
    return (
        payments(spark, folder)
        .select("payment_id", "order_id", "updated_at", F.posexplode(steps).alias("seq", "step"))
        .select(
            "payment_id",
            "order_id",
            F.col("step.status").alias("payment_status"),
            F.col("step.op").alias(OP),
            F.expr(f"updated_at div 1000 + seq * {DAY_MS}").alias(TS),
            "seq",
        )
    )


def product_changes(spark: SparkSession, folder: str) -> DataFrame:
    return products(spark, folder).select(
        "product_id",
        "product_name",
        F.lit("r").alias(OP),
        F.lit(0).cast("bigint").alias(TS),
        F.lit(0).alias("seq"),
    )


def status_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The orders of a customer read as one status log, with ties in time."""
    return read(spark, folder, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("seq"),
        millis("o_orderdate").alias(TS),
        _status("o_orderstatus").alias("order_status"),
    )
