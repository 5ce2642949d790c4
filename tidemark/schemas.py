"""Declared source tables: columns, keys, constraints."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The source schema, its value domains and the topic naming.
TOPIC_PREFIX = "ecom.public."

CATEGORIES = ("Electronics", "Home & Kitchen", "Clothing", "Books", "Sports", "Beauty")
PAYMENT_METHODS = ("credit_card", "debit_card", "paypal", "wallet")
ORDER_STATUSES = ("PENDING", "PAID", "SHIPPED", "DELIVERED", "CANCELLED")
PAYMENT_STATUSES = ("INITIATED", "SUCCESS")

# Metadata columns every bronze row carries.
OP = "_cdc_op"
TS = "_cdc_ts_ms"
SOURCE = "_source_table"
INGESTED = "_ingested_at"
PARTITION = "_partition"
OFFSET = "_offset"
RAW = "_raw"

# Position of a message within its table's topic; unique per event.
SEQ = (PARTITION, OFFSET)


@dataclass(frozen=True)
class Table:
    """One source table. Money is double and time is epoch microseconds, as in events."""

    name: str
    key: str
    row: T.StructType
    not_null: tuple[str, ...]
    unique: tuple[str, ...] = ()
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)
    max_length: dict[str, int] = field(default_factory=dict)
    money: tuple[str, ...] = ()
    times: tuple[str, ...] = ()
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def topic(self) -> str:
        return TOPIC_PREFIX + self.name


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "binary": T.BinaryType(),
}


def row_schema(columns: str) -> T.StructType:
    """A row schema from ``"name type, ..."``; unlike a DDL parse it needs no session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


CUSTOMERS = Table(
    name="customers",
    key="customer_id",
    row=row_schema(
        "customer_id bigint, full_name string, email string, country string,"
        " signup_date bigint, updated_at bigint"
    ),
    not_null=("customer_id", "full_name", "email", "signup_date", "updated_at"),
    unique=("customer_id", "email"),
    max_length={"full_name": 150, "email": 150, "country": 80},
    times=("signup_date", "updated_at"),
)

PRODUCTS = Table(
    name="products",
    key="product_id",
    row=row_schema(
        "product_id bigint, product_name string, category string, price double,"
        " stock_quantity int, updated_at bigint"
    ),
    not_null=("product_id", "product_name", "price", "stock_quantity", "updated_at"),
    unique=("product_id",),
    max_length={"product_name": 200, "category": 100},
    money=("price",),
    times=("updated_at",),
    accepted={"category": CATEGORIES},
)

ORDERS = Table(
    name="orders",
    key="order_id",
    row=row_schema(
        "order_id bigint, customer_id bigint, order_status string, order_date bigint,"
        " updated_at bigint"
    ),
    not_null=("order_id", "customer_id", "order_status", "order_date", "updated_at"),
    unique=("order_id",),
    foreign_keys={"customer_id": ("customers", "customer_id")},
    max_length={"order_status": 30},
    times=("order_date", "updated_at"),
    accepted={"order_status": ORDER_STATUSES},
)

ORDER_ITEMS = Table(
    name="order_items",
    key="order_item_id",
    row=row_schema(
        "order_item_id bigint, order_id bigint, product_id bigint, quantity int,"
        " unit_price double, updated_at bigint"
    ),
    not_null=("order_item_id", "order_id", "product_id", "quantity", "unit_price", "updated_at"),
    unique=("order_item_id",),
    foreign_keys={"order_id": ("orders", "order_id"), "product_id": ("products", "product_id")},
    money=("unit_price",),
    times=("updated_at",),
)

PAYMENTS = Table(
    name="payments",
    key="payment_id",
    row=row_schema(
        "payment_id bigint, order_id bigint, payment_status string, payment_method string,"
        " amount double, paid_at bigint, updated_at bigint"
    ),
    not_null=("payment_id", "order_id", "payment_status", "amount", "updated_at"),
    unique=("payment_id",),
    foreign_keys={"order_id": ("orders", "order_id")},
    max_length={"payment_status": 30, "payment_method": 50},
    money=("amount",),
    times=("paid_at", "updated_at"),
    accepted={"payment_status": PAYMENT_STATUSES, "payment_method": PAYMENT_METHODS},
)

TABLES = {t.name: t for t in (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS, PAYMENTS)}
