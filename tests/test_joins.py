from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.plans import marts
from tidemark.sources import star


def rows(df):
    return Counter(map(tuple, df.select(*sorted(df.columns)).collect()))


def test_fact_with_hot_orders(spark, folder):
    orders, items = star.orders(spark, folder), star.order_items(spark, folder)
    payments = star.payments(spark, folder)
    hot = payments.union(payments.where("order_id < 3").withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("x"))
    hot = hot.withColumn("order_id", F.when(F.col("payment_id") % 11 > 0, F.col("order_id")))
    plain = (
        orders.join(marts.order_totals(items), "order_id", "left")
        .join(hot.select("order_id", "payment_status", "payment_method"), "order_id", "left")
    )
    assert rows(marts.fct_orders(orders, items, hot)) == rows(plain)


def test_prices_that_are_no_money(spark):
    items = spark.createDataFrame(
        [(1, 1, 1e18), (1, 1, 1.0), (2, 3, 0.335), (3, 2, float("nan")), (3, 1, 2.5),
         (4, 1, float("nan")), (5, 2**31 - 1, 1e21), (5, 2**31 - 1, 9e21), (6, 1, 1e30)],
        "order_id bigint, quantity int, unit_price double",
    )
    found = {r[0]: r[1] for r in marts.order_totals(items).select("order_id", "order_revenue").collect()}
    assert found[1] == 1e18 + 1 and found[2] == 1.005 and found[3] == 2.5
    assert found[4] is None and found[6] is None
    assert found[5] == pytest.approx((2**31 - 1) * 1e22, rel=1e-12)


def test_fact_edges(spark):
    orders = spark.createDataFrame(
        [(1, 7, "PAID", 5), (2, 7, "PENDING", 6), (3, 8, "PENDING", 7)],
        "order_id bigint, customer_id bigint, order_status string, order_date bigint",
    )
    items = spark.createDataFrame(
        [(1, 2, 0.1), (1, 1, 0.2), (2, None, 5.0), (2, 3, None)],
        "order_id bigint, quantity int, unit_price double",
    )
    payments = spark.createDataFrame(
        [(10, 1, "INITIATED", "wallet"), (11, 1, "SUCCESS", None), (12, 99, "SUCCESS", "paypal")],
        "payment_id bigint, order_id bigint, payment_status string, payment_method string",
    )
    fact = {tuple(r) for r in marts.fct_orders(orders, items, payments).collect()}
    assert fact == {
        (1, 7, "PAID", 5, 0.4, 3, "INITIATED", "wallet"),
        (1, 7, "PAID", 5, 0.4, 3, "SUCCESS", None),
        (2, 7, "PENDING", 6, None, 3, None, None),
        (3, 8, "PENDING", 7, None, None, None, None),
    }
    latest = marts.fct_orders(orders, items, payments, latest_payment=True).collect()
    assert {(r[0], r[6]) for r in latest} == {(1, "SUCCESS"), (2, None), (3, None)}


def test_foreign_key_ignores_null_and_finds_orphans(spark):
    child = spark.createDataFrame([(1, 5), (2, 6), (3, None), (4, 6)], "id int, ref int")
    parent = spark.createDataFrame([(5,), (5,), (None,)], "key int")
    bad = quality.check_foreign_key(child, "ref", parent, "key")
    assert sorted(map(tuple, bad.collect())) == [(2, 6), (4, 6)]
