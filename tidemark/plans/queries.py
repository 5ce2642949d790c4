"""Every operator as a query over the star-schema files: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import capture, continuity, envelope, history, quality, sampling, state
from tidemark.plans import marts, pipeline
from tidemark.schemas import (
    CATEGORIES,
    CUSTOMERS,
    INGESTED,
    OFFSET,
    OP,
    ORDER_ITEMS,
    ORDER_STATUSES,
    ORDERS,
    PAYMENTS,
    PRODUCTS,
    SOURCE,
    TS,
)
from tidemark.session import scratch_dir
from tidemark.sources import buckets, images, keysets, star, tables
from tidemark.streaming import jobs, statestore
from tidemark.streaming.messages import file_messages

Query = Callable[[SparkSession, str], DataFrame]

AS_OF_MS = 1_705_000_000_000
USER = {"keys": "user_id", "ts": TS, "seq": "event_id"}
USER_TRACKED = ["event_type", "value", "props"]
USER_COLUMNS = ["user_id", "event_id", TS, OP, *USER_TRACKED]


def _plain(df: DataFrame) -> DataFrame:
    """Metadata columns under names without a leading underscore."""
    return df.withColumnsRenamed({OP: "op", TS: "ts_ms", SOURCE: "source_table", OFFSET: "offset"})


# -- marts --------------------------------------------------------------------


def fct_orders(spark: SparkSession, folder: str) -> DataFrame:
    silver = marts.register_staging(
        {
            "orders": star.orders(spark, folder),
            "order_items": star.order_items(spark, folder),
            "payments": star.payments(spark, folder),
        }
    )
    return marts.fct_orders(silver["orders"], silver["order_items"], silver["payments"])


def fct_orders_latest_payment(spark: SparkSession, folder: str) -> DataFrame:
    return marts.fct_orders(
        star.orders(spark, folder),
        star.order_items(spark, folder),
        star.payments(spark, folder),
        latest_payment=True,
    )


def dim_customers(spark: SparkSession, folder: str) -> DataFrame:
    log = star.customer_changes(spark, folder)
    silver = state.current_state(log, "customer_id", seq="seq")
    return marts.dim_customers(marts.register_staging({"customers": silver})["customers"])


def customer_history(spark: SparkSession, folder: str) -> DataFrame:
    return marts.customer_history(star.customer_changes(spark, folder), "seq")


def preview_dim(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.preview(dim_customers(spark, folder), "customer_id", 5)


def sample_products(spark: SparkSession, folder: str) -> DataFrame:
    """Four products drawn at random, as for a new order."""
    drawn = sampling.sample_rows(star.products(spark, folder), "product_id", 4, seed=1)
    return drawn.select("product_id", "price")


def typed_payments(spark: SparkSession, folder: str) -> DataFrame:
    """Payments in the source's types, shown as text."""
    rows = marts.typed(star.payments(spark, folder), PAYMENTS)
    return rows.select(
        "payment_id",
        F.col("amount").cast("string").alias("amount"),
        F.date_format("paid_at", "yyyy-MM-dd HH:mm:ss").alias("paid_at"),
    )


# -- current state ------------------------------------------------------------


def current_users(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(state.current_state(star.user_changes(spark, folder), **USER))


def current_with_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    log = star.user_changes(spark, folder)
    return _plain(state.current_state(log.unionAll(log), **USER))


def current_all(spark: SparkSession, folder: str) -> DataFrame:
    logs = [
        (CUSTOMERS, star.customer_changes),
        (PRODUCTS, star.product_changes),
        (ORDERS, star.order_changes),
        (ORDER_ITEMS, star.order_item_changes),
        (PAYMENTS, star.payment_changes),
    ]
    parts = [
        state.current_state(log(spark, folder), table.key, seq="seq").select(
            F.lit(table.name).alias("source_table"),
            F.col(table.key).alias("key"),
            F.col(TS).alias("ts_ms"),
        )
        for table, log in logs
    ]
    return reduce(DataFrame.unionByName, parts)


def deleted_users(spark: SparkSession, folder: str) -> DataFrame:
    return state.deleted_keys(star.user_changes(spark, folder), **USER)


def state_as_of(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(state.current_state(star.user_changes(spark, folder), **USER, as_of=AS_OF_MS))


def silver_audit(spark: SparkSession, folder: str) -> DataFrame:
    return state.audit(star.user_changes(spark, folder), **USER)


def merge_increment(spark: SparkSession, folder: str) -> DataFrame:
    log = star.user_changes(spark, folder)
    # Newer events first, the older ones late: deletes must hold against them.
    newer, older = log.where(F.col(TS) > AS_OF_MS), log.where(F.col(TS) <= AS_OF_MS)
    first = state.latest_per_key(newer, **USER)
    return _plain(state.without_deletes(state.merge_changes(first, older, **USER)))


# -- messages and bronze ------------------------------------------------------


def _bronze(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    messages = star.user_messages(star.read(spark, folder, "events"))
    return envelope.parse_events(messages, star.USER_ROW, "users")


def bronze_events(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = _bronze(spark, folder)
    return _plain(rows.select(*star.USER_ROW.fieldNames(), OP, TS, SOURCE, OFFSET))


def bronze_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    _, malformed = _bronze(spark, folder)
    return malformed.select(
        F.col(SOURCE).alias("source_table"),
        F.col(OFFSET).alias("offset"),
        F.col(envelope.ERROR).alias("reason"),
    )


def bronze_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Events per table and op, from the messages of several topics in one stream."""
    topics = {
        "users": (star.user_messages(star.read(spark, folder, "events")), star.USER_ROW),
        "customers": (
            star.log_messages(star.customer_changes(spark, folder), CUSTOMERS),
            CUSTOMERS.row,
        ),
        "products": (
            star.log_messages(star.product_changes(spark, folder), PRODUCTS),
            PRODUCTS.row,
        ),
    }
    together = reduce(DataFrame.unionByName, [messages for messages, _ in topics.values()])
    rows = [
        envelope.parse_events(together, schema, table)[0].select(SOURCE, OP)
        for table, (_, schema) in topics.items()
    ]
    return (
        reduce(DataFrame.unionByName, rows)
        .groupBy(F.col(SOURCE).alias("source_table"), F.col(OP).alias("op"))
        .agg(F.count(F.lit(1)).alias("events"))
    )


def bronze_reparsed(spark: SparkSession, folder: str) -> DataFrame:
    """Rows first read without ``props``, then again from the raw message with it."""
    messages = star.user_messages(star.read(spark, folder, "events"))
    narrow = type(star.USER_ROW)(star.USER_ROW.fields[:3])
    first, _ = envelope.parse_events(messages, narrow, "users")
    again = envelope.reparse(first, star.USER_ROW, "users")
    return _plain(again.select(*star.USER_ROW.fieldNames(), OP, TS, SOURCE, OFFSET))


def observed_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = _bronze(spark, folder)
    return envelope.observed_columns(rows).withColumnRenamed(SOURCE, "source_table")


def schema_evolution(spark: SparkSession, folder: str) -> DataFrame:
    """Rows appended before and after the table gained a column."""
    path = scratch_dir(spark, "appended")
    log = star.user_changes(spark, folder)
    old = log.where(F.col(TS) <= AS_OF_MS).select("user_id", "event_id", "event_type")
    new = log.where(F.col(TS) > AS_OF_MS).select("user_id", "event_id", "event_type", "value")
    for rows in (old, new):
        tables.append(rows, path)
    return tables.read(spark, path)


def schema_type_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Rows appended before and after columns of the table changed their types."""
    path = scratch_dir(spark, "drifted")
    log = star.user_changes(spark, folder).withColumn("at", F.timestamp_millis(TS))
    old = log.where(F.col(TS) <= AS_OF_MS).select(
        F.col("user_id").cast("int").alias("user_id"), "event_id", "value",
        F.col("at").cast("date").alias("at"), F.col("event_id").alias("code"),
    )
    new = log.where(F.col(TS) > AS_OF_MS).select(
        "event_id", "user_id", F.floor("value").cast("int").alias("value"), "at",
        F.col("event_type").alias("code"),
    )
    for rows in (old, new):
        tables.append(rows, path)
    return tables.read(spark, path).withColumn("at", F.unix_millis("at"))


def bronze_ingest_time(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows have an ISO time of day as their ingest time."""
    rows, _ = _bronze(spark, folder)
    shape = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}$"
    return rows.groupBy(F.col(INGESTED).rlike(shape).alias("iso")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def silver_replaced(spark: SparkSession, folder: str) -> DataFrame:
    """A table that held a past state, replaced by the state of now."""
    path = scratch_dir(spark, "replaced")
    log = star.user_changes(spark, folder)
    tables.replace(state.current_state(log, **USER, as_of=AS_OF_MS), path)
    tables.replace(state.current_state(log, **USER), path)
    return _plain(tables.read_current(spark, path))


def silver_published(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as published: a version with gaps in it has been held back by its gate."""
    path = scratch_dir(spark, "published")
    columns = ["customer_id", "full_name", "email", "country"]
    whole, gaps = star.customers(spark, folder).select(*columns), _gaps(spark, folder).select(*columns)
    for rows in (whole, gaps):
        tables.publish(rows, path, quality.row_rules(CUSTOMERS, columns))
    return tables.read_current(spark, path)


def silver_skipped(spark: SparkSession, folder: str) -> DataFrame:
    """Silver customers after a run over a log that holds malformed messages only."""
    bronze, silver, marks = (scratch_dir(spark, n) for n in ("bronze", "silver", "marks"))
    before = star.customers(spark, folder).select("customer_id", "full_name", "email", "country")
    tables.replace(before.withColumn(OP, F.lit("c")), f"{silver}/customers")
    messages = star.user_messages(_event_stream(spark, folder))
    cut = messages.select(
        F.lit("ecom.public.customers").alias("topic"), "partition", "offset",
        F.left(F.col("value").cast("string"), F.lit(9)).cast("binary").alias("value"),
    )
    for query in pipeline.start_ingest(cut, bronze, marks, ["customers"], jobs.ALL_THERE_IS):
        query.awaitTermination()
    pipeline.build_silver(spark, bronze, silver, ["customers"])
    return pipeline.read_silver(spark, silver, "customers").drop(OP)


def gold_materialized(spark: SparkSession, folder: str) -> DataFrame:
    """The customer dimension by way of a silver and a gold folder."""
    silver, gold = scratch_dir(spark, "silver"), scratch_dir(spark, "gold")
    log = star.customer_changes(spark, folder)
    tables.replace(state.current_state(log, "customer_id", seq="seq"), f"{silver}/customers")
    pipeline.build_gold(spark, silver, gold)
    return tables.read_current(spark, f"{gold}/dim_customers_scd2")


def snapshot_events(spark: SparkSession, folder: str) -> DataFrame:
    events = capture.snapshot_events(
        star.customers(spark, folder).select("customer_id", "full_name", "email", "country"),
        AS_OF_MS,
    )
    return events.select("op", "ts_ms", F.col("before").isNull().alias("no_before"), "after.*")


def snapshot_diff(spark: SparkSession, folder: str) -> DataFrame:
    base = star.customers(spark, folder)
    columns = ["customer_id", "full_name", "email", "country"]
    old = base.where("c_mktsegment <> 'AUTOMOBILE'").select(*columns)
    moved = F.when(F.col("c_mktsegment") == "BUILDING", "MOVED").otherwise(F.col("country"))
    new = base.where("c_mktsegment <> 'MACHINERY'").withColumn("country", moved).select(*columns)
    events = capture.snapshot_diff(old, new, "customer_id", AS_OF_MS)
    return events.select(
        "op",
        "ts_ms",
        capture.row_image().getField("customer_id").alias("customer_id"),
        F.col("before.country").alias("old_country"),
        F.col("after.country").alias("new_country"),
    )


_IMAGE = ["customer_id", "full_name", "email", "country"]


def snapshot_diff_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Few changes between two stored images: most buckets are not read again."""
    old, new = scratch_dir(spark, "old"), scratch_dir(spark, "new")
    base = star.customers(spark, folder).select(*_IMAGE)
    key = F.col("customer_id")
    moved = F.when(key % 997 == 1, "MOVED").otherwise(F.col("country"))
    images.save_image(base.where(key % 997 != 2), old, "customer_id")
    images.save_image(base.where(key % 997 != 3).withColumn("country", moved), new, "customer_id")
    events = images.image_diff(spark, old, new, "customer_id", AS_OF_MS)
    return events.select(
        "op",
        capture.row_image().getField("customer_id").alias("customer_id"),
        F.col("before.country").alias("old_country"),
        F.col("after.country").alias("new_country"),
    )


# States are kept at these times and asked for at the others; events of the log arrive late.
KEPT_MS = (1_704_672_000_000, 1_705_449_600_000)
ASKED_MS = (1_704_400_000_000, AS_OF_MS, 1_706_000_000_000)


def state_as_of_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Past states from kept ones. Every seventh event comes two days late, some after a state
    for its time has been kept."""
    path, kept = scratch_dir(spark, "log"), scratch_dir(spark, "kept")
    late = F.when(F.col("event_id") % 7 == 0, 2).otherwise(0)
    day = F.date_add(F.timestamp_millis(TS).cast("date"), late)
    log = star.user_changes(spark, folder).withColumn(jobs.DAY, day)
    first = F.col(jobs.DAY) <= F.lit("2024-01-09").cast("date")
    for part, at in zip((first, ~first), KEPT_MS):
        log.where(part).write.mode("append").partitionBy(jobs.DAY).parquet(path)
        images.save_state(spark.read.parquet(path), kept, at, jobs.DAY, **USER)
    parts = [
        images.state_as_of(spark.read.parquet(path), kept, at, jobs.DAY, **USER).select(
            F.lit(at).cast("bigint").alias("as_of"), *USER_COLUMNS
        )
        for at in ASKED_MS
    ]
    return _plain(reduce(DataFrame.unionByName, parts))


# -- continuity ---------------------------------------------------------------


def _topic_log(spark: SparkSession, folder: str) -> DataFrame:
    """The messages of three topic partitions; some have been lost, others read twice."""
    number = (F.col("offset") / 2).cast("bigint")
    sent = star.user_messages(star.read(spark, folder, "events")).where("offset % 2 = 0")
    log = sent.select(
        "topic", (number % 3).cast("int").alias("partition"),
        F.floor(number / 3).alias("offset"), number.alias("_no"),
    )
    read = log.where(~((F.col("_no") % 97 == 0) | F.col("_no").between(100, 160)))
    return read.unionAll(read.where(F.col("_no") % 53 == 0)).drop("_no")


def log_missing(spark: SparkSession, folder: str) -> DataFrame:
    return continuity.missing(_topic_log(spark, folder), first=0)


def log_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return continuity.ranges(_topic_log(spark, folder))


def log_read_again(spark: SparkSession, folder: str) -> DataFrame:
    return continuity.read_again(_topic_log(spark, folder))


# -- history ------------------------------------------------------------------


def scd2_from_current(spark: SparkSession, folder: str) -> DataFrame:
    silver = state.current_state(star.user_changes(spark, folder), **USER)
    return history.validity(silver, "user_id", USER_TRACKED, TS)


def scd2_history(spark: SparkSession, folder: str) -> DataFrame:
    return history.scd2(star.user_changes(spark, folder), tracked=USER_TRACKED, **USER)


def scd2_history_compact(spark: SparkSession, folder: str) -> DataFrame:
    log = star.user_changes(spark, folder)
    return history.scd2(log, tracked=["event_type"], **USER, compact=True)


def transitions(spark: SparkSession, folder: str) -> DataFrame:
    return history.transitions(star.user_changes(spark, folder), col=OP, **USER)


def event_order(spark: SparkSession, folder: str) -> DataFrame:
    log = star.user_changes(spark, folder).select("user_id", "event_id", TS)
    return _plain(history.event_order(log, **USER))


# -- quality ------------------------------------------------------------------


def _gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Customers without a name or country where the balance is overdrawn."""
    overdrawn = F.col("c_acctbal") < 0
    return (
        star.customers(spark, folder)
        .withColumn("full_name", F.when(~overdrawn, F.col("full_name")))
        .withColumn("email", F.when(F.col("c_acctbal") < 9000, F.col("email")))
    )


def _coded(spark: SparkSession, folder: str) -> DataFrame:
    """Products with long names, and categories of which one is not accepted."""
    types = ("ECONOMY", "LARGE", "PROMO", "SMALL", "STANDARD")
    category = F.lit("Garden")
    for t, c in zip(types, CATEGORIES):
        category = F.when(F.col("category") == t, c).otherwise(category)
    return (
        star.products(spark, folder)
        .withColumn("category", category)
        .withColumn("product_name", F.expr("repeat(product_name, stock_quantity)"))
    )


def _scaled(spark: SparkSession, folder: str) -> DataFrame:
    """Order amounts in thousandths: some too large for the money type."""
    return star.read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("payment_id"), (F.col("o_totalprice") * 1000).alias("amount")
    )


def q_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return quality.check_not_null(
        _gaps(spark, folder), "customer_id", ["customer_id", "full_name", "email"]
    )


def q_unique(spark: SparkSession, folder: str) -> DataFrame:
    return quality.check_unique(star.order_items(spark, folder), "order_item_id")


def q_foreign_key(spark: SparkSession, folder: str) -> DataFrame:
    """The four references, each against a parent from which some rows are missing."""
    customers = star.customers(spark, folder).where("c_acctbal >= 0")
    orders = star.orders(spark, folder)
    open_orders = orders.where("order_status <> 'PAID'")
    products = star.products(spark, folder).where("stock_quantity > 5")
    items = star.order_items(spark, folder)
    payments = star.payments(spark, folder)
    checks = [
        ("orders.customer_id", orders, "order_id", "customer_id", customers, "customer_id"),
        ("order_items.order_id", items, "order_item_id", "order_id", open_orders, "order_id"),
        ("order_items.product_id", items, "order_item_id", "product_id", products, "product_id"),
        ("payments.order_id", payments, "payment_id", "order_id", open_orders, "order_id"),
    ]
    parts = []
    for name, child, key, col, parent, parent_key in checks:
        narrow = child.select(F.col(key).alias("id"), F.col(col).alias("reference"))
        bad = quality.check_foreign_key(narrow, "reference", parent, parent_key)
        parts.append(bad.select(F.lit(name).alias("check"), "id", "reference"))
    return reduce(DataFrame.unionByName, parts)


def _batches(df: DataFrame, n: int = 3) -> list[DataFrame]:
    """A table as it comes in batches."""
    return [df.where(F.pmod(F.xxhash64(*df.columns), F.lit(n)) == i) for i in range(n)]


def q_unique_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated item numbers, each batch checked against a bitmap of the ones before it."""
    path = scratch_dir(spark, "item-keys")
    items = star.order_items(spark, folder).select("order_item_id", "product_id", "quantity")
    for batch in _batches(items):
        known = keysets.read_set(spark, path)
        repeated = keysets.repeated_keys(batch, "order_item_id", known)
        tables.append(repeated, f"{path}-repeated")
        keysets.add_keys(batch, "order_item_id", path)
    return tables.read(spark, f"{path}-repeated").distinct()


def q_foreign_key_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Items whose product is unknown, each batch checked against a bitmap of the products."""
    path = scratch_dir(spark, "product-keys")
    products = star.products(spark, folder).where("stock_quantity > 5").select("product_id", "price")
    for batch in _batches(products):
        keysets.add_keys(batch, "product_id", path)
    items = star.order_items(spark, folder).select("order_item_id", "product_id")
    known = keysets.read_set(spark, path)
    bad = [keysets.orphans(batch, "product_id", known) for batch in _batches(items)]
    return reduce(DataFrame.unionByName, bad)


def q_length(spark: SparkSession, folder: str) -> DataFrame:
    return quality.check_length(_coded(spark, folder), "product_id", PRODUCTS.max_length)


def q_decimal(spark: SparkSession, folder: str) -> DataFrame:
    return quality.check_decimal(_scaled(spark, folder), "payment_id", ["amount"])


def q_accepted(spark: SparkSession, folder: str) -> DataFrame:
    return quality.check_accepted(_coded(spark, folder), "product_id", PRODUCTS.accepted)


def q_transition(spark: SparkSession, folder: str) -> DataFrame:
    bad = quality.check_transitions(
        star.status_changes(spark, folder), "customer_id", seq="seq", chain=ORDER_STATUSES
    )
    return bad.select("customer_id", "seq", "previous", "order_status")


def _stated_payments(spark: SparkSession, folder: str) -> DataFrame:
    """Settled payments carry the item total, every seventh a bit more; the others the price
    that the order states."""
    totals = marts.order_totals(star.order_items(spark, folder))
    settled = F.col("paid_at").isNotNull() & F.col("order_revenue").isNotNull()
    more = F.when(F.col("payment_id") % 7 == 0, 0.25).otherwise(0.0)
    amount = F.when(settled, F.round("order_revenue", 2) + more).otherwise(F.col("amount"))
    paired = star.payments(spark, folder).join(totals, "order_id", "left")
    return paired.select("payment_id", "order_id", amount.alias("amount"))


def q_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    totals = marts.order_totals(star.order_items(spark, folder))
    return quality.check_amounts(_stated_payments(spark, folder), totals)


def q_paid(spark: SparkSession, folder: str) -> DataFrame:
    # The payments of orders of medium priority have not been captured.
    payments = star.payments(spark, folder).where("payment_method <> 'paypal'")
    return quality.check_paid(star.orders(spark, folder), payments).select("order_id", "order_status")


def q_gate(spark: SparkSession, folder: str) -> DataFrame:
    gaps, coded, scaled = _gaps(spark, folder), _coded(spark, folder), _scaled(spark, folder)
    items, orders = star.order_items(spark, folder), star.orders(spark, folder)
    narrow = items.select("order_item_id", "product_id")
    known = star.products(spark, folder).where("stock_quantity > 5")
    return quality.gate(
        [
            quality.summarize(gaps, quality.row_rules(CUSTOMERS, gaps.columns), "customers"),
            quality.summarize(coded, quality.row_rules(PRODUCTS, coded.columns), "products"),
            quality.summarize(orders, quality.row_rules(ORDERS, orders.columns), "orders"),
            quality.summarize(scaled, quality.row_rules(PAYMENTS, scaled.columns), "payments"),
            quality.summarize_unique(items, "order_item_id", "order_items.unique:order_item_id"),
            quality.summarize_foreign_key(
                narrow, "product_id", known, "product_id", "order_items.foreign_key:product_id"
            ),
            quality.count_violations(
                star.status_changes(spark, folder),
                q_transition(spark, folder),
                "orders.status_chain",
            ),
            quality.count_violations(
                star.payments(spark, folder),
                q_reconcile(spark, folder),
                "payments.amount_is_item_total",
            ),
            quality.count_violations(orders, q_paid(spark, folder), "orders.paid_has_payment"),
        ]
    )


# -- streams ------------------------------------------------------------------


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table, one file or a folder of them, as a stream."""
    schema = star.read(spark, folder, "events").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/events.[p]arquet")


def stream_bronze(spark: SparkSession, folder: str) -> DataFrame:
    path, checkpoint = scratch_dir(spark, "bronze"), scratch_dir(spark, "checkpoint")
    messages = star.user_messages(_event_stream(spark, folder))
    jobs.ingest(
        messages, star.USER_ROW, "users", path, checkpoint, jobs.ALL_THERE_IS
    ).awaitTermination()
    rows = jobs.read_bronze(spark, path, star.USER_ROW)
    return _plain(rows.select(*star.USER_ROW.fieldNames(), OP, TS, SOURCE, OFFSET))


def bronze_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """The log after its days have been rewritten to few files; a batch came after that."""
    landed, path, checkpoint = (scratch_dir(spark, n) for n in ("landed", "log", "checkpoint"))
    messages = star.user_messages(star.read(spark, folder, "events"))
    for part in range(3):
        messages.where(F.col("offset") % 3 == part).write.mode("append").parquet(landed)
        jobs.ingest(
            file_messages(spark, landed), star.USER_ROW, "users", path, checkpoint, jobs.ALL_THERE_IS
        ).awaitTermination()
        if part < 2:
            jobs.compact_log(spark, path, star.USER_ROW, "user_id", before="9999-01-01")
    rows = jobs.read_bronze(spark, path, star.USER_ROW)
    return _plain(rows.select(*star.USER_ROW.fieldNames(), OP, TS, SOURCE, OFFSET))


def ingest_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Micro-batches of two files at most: whether there are as many as that takes, and all
    messages came."""
    landed, path, checkpoint = (scratch_dir(spark, n) for n in ("landed", "log", "checkpoint"))
    messages = star.user_messages(star.read(spark, folder, "events"))
    messages.repartition(5, "offset").write.parquet(landed)
    files = len(spark.read.parquet(landed).inputFiles())
    jobs.ingest(
        file_messages(spark, landed, max_files=2),
        star.USER_ROW, "users", path, checkpoint, jobs.ALL_THERE_IS,
    ).awaitTermination()
    batches = jobs.ingested_batches(spark, path, star.USER_ROW)
    return batches.agg(
        (F.count(F.lit(1)) == -(-files // 2)).alias("batches_as_due"),
        F.sum("messages").alias("messages"),
        F.sum("failed").alias("failed"),
    )


def _kept_by(spark: SparkSession, folder: str, job) -> tuple[str, str]:
    """State table and checkpoint of a streaming job that is stopped and started again.

    The newer half of the user log lands first, so the older half arrives late.
    """
    landed, path, checkpoint = (scratch_dir(spark, n) for n in ("landed", "state", "checkpoint"))
    log = star.user_changes(spark, folder)
    for part in (F.col(TS) > AS_OF_MS, F.col(TS) <= AS_OF_MS):
        log.where(part).write.mode("append").parquet(landed)
        arriving = spark.readStream.schema(log.schema).parquet(landed)
        job(arriving, path, checkpoint, **USER, trigger=jobs.ALL_THERE_IS).awaitTermination()
    return path, checkpoint


def _maintained(spark: SparkSession, folder: str, job) -> DataFrame:
    path, _ = _kept_by(spark, folder, job)
    latest = buckets.read_state(spark, path)
    return _plain(state.without_deletes(latest).select(*USER_COLUMNS))


def stream_merge(spark: SparkSession, folder: str) -> DataFrame:
    return _maintained(spark, folder, jobs.stream_merge)


def stream_current(spark: SparkSession, folder: str) -> DataFrame:
    return _maintained(spark, folder, jobs.stream_current)


def state_store(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of the state store after a restart, of the log, and those on which they differ."""
    _, checkpoint = _kept_by(spark, folder, jobs.stream_current)
    kept = statestore.kept_rows(spark, checkpoint)
    return statestore.compare(kept, star.user_changes(spark, folder), **USER)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        fct_orders,
        fct_orders_latest_payment,
        dim_customers,
        customer_history,
        preview_dim,
        sample_products,
        typed_payments,
        current_users,
        current_with_duplicates,
        current_all,
        deleted_users,
        state_as_of,
        silver_audit,
        merge_increment,
        bronze_events,
        bronze_quarantine,
        bronze_counts,
        bronze_reparsed,
        observed_columns,
        schema_evolution,
        schema_type_drift,
        snapshot_events,
        snapshot_diff,
        snapshot_diff_stored,
        state_as_of_kept,
        log_missing,
        log_ranges,
        log_read_again,
        scd2_from_current,
        scd2_history,
        scd2_history_compact,
        transitions,
        event_order,
        bronze_ingest_time,
        silver_replaced,
        silver_published,
        silver_skipped,
        gold_materialized,
        stream_bronze,
        bronze_compacted,
        ingest_batches,
        stream_merge,
        stream_current,
        state_store,
        q_not_null,
        q_unique,
        q_unique_batches,
        q_foreign_key,
        q_foreign_key_batches,
        q_length,
        q_decimal,
        q_accepted,
        q_transition,
        q_reconcile,
        q_paid,
        q_gate,
    )
}
