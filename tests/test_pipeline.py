import json

import pytest
from pyspark.sql import types as T

from tidemark.__main__ import main
from tidemark.operators import quality
from tidemark.plans import pipeline
from tidemark.schemas import OP, TABLES, TS
from tidemark.sources import tables
from tidemark.streaming import jobs
from tidemark.streaming.messages import MESSAGE, file_messages

CUSTOMER = {"full_name": "Ann", "email": "ann@x", "country": "A", "signup_date": 1, "updated_at": 1}
PRODUCT = {"product_name": "p", "category": "Books", "price": 2.5, "stock_quantity": 3, "updated_at": 1}

LOG = [
    ("customers", "r", 1, {"customer_id": 1, **CUSTOMER}),
    ("customers", "r", 1, {"customer_id": 2, **CUSTOMER, "email": "bob@x"}),
    ("customers", "u", 5, {"customer_id": 1, **CUSTOMER, "country": "B"}),
    ("customers", "d", 6, {"customer_id": 2, **CUSTOMER, "email": "bob@x"}),
    ("products", "r", 1, {"product_id": 9, **PRODUCT}),
    ("orders", "c", 2, {"order_id": 5, "customer_id": 1, "order_status": "PENDING", "order_date": 3, "updated_at": 3}),
    ("orders", "u", 3, {"order_id": 5, "customer_id": 1, "order_status": "PAID", "order_date": 3, "updated_at": 4}),
    ("order_items", "c", 2, {"order_item_id": 7, "order_id": 5, "product_id": 9, "quantity": 2, "unit_price": 2.5, "updated_at": 3}),
    ("payments", "c", 2, {"payment_id": 8, "order_id": 5, "payment_status": "INITIATED", "payment_method": "wallet", "amount": 5.0, "paid_at": None, "updated_at": 3}),
    ("payments", "u", 3, {"payment_id": 8, "order_id": 5, "payment_status": "SUCCESS", "payment_method": "wallet", "amount": 5.0, "paid_at": 4, "updated_at": 4}),
]


def land(spark, path, log, start=0):
    rows = []
    for offset, (table, op, ts, row) in enumerate(log, start):
        gone = op == "d"
        event = {"op": op, "ts_ms": ts, "before": row if gone else None, "after": None if gone else row}
        rows.append((f"ecom.public.{table}", 0, offset, json.dumps({"payload": event}).encode()))
    spark.createDataFrame(rows, MESSAGE).write.mode("append").parquet(path)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """The whole pipeline once, over landed messages."""
    root = tmp_path_factory.mktemp("pipeline")
    at = {n: str(root / n) for n in ("landed", "bronze", "silver", "kept", "gold", "marks")}
    land(spark, at["landed"], LOG)
    finish(pipeline.start_ingest(
        file_messages(spark, at["landed"]), at["bronze"], at["marks"], trigger=jobs.ALL_THERE_IS
    ))
    at["written"] = pipeline.build_silver(spark, at["bronze"], at["silver"])
    finish(pipeline.start_silver(
        spark, at["bronze"], at["kept"], at["marks"], trigger=jobs.ALL_THERE_IS
    ))
    return at


def finish(queries):
    for query in queries:
        query.awaitTermination()


def test_silver_is_written_once_per_table(run):
    assert run["written"] == {n: 0 for n in TABLES}


@pytest.mark.parametrize("silver", ["silver", "kept"])
def test_models(spark, run, silver):
    found = pipeline.models(spark, run[silver])
    assert [tuple(r) for r in found["fct_orders"].collect()] == [
        (5, 1, "PAID", 3, 5.0, 2, "SUCCESS", "wallet")
    ]
    assert [tuple(r) for r in found["dim_customers_scd2"].collect()] == [
        (1, "Ann", "ann@x", "B", 5, None, True)
    ]
    (customer,) = found["stg_customers"].collect()
    assert (customer[OP], customer[TS], customer["country"]) == ("u", 5, "B")
    assert spark.table("stg_products").count() == 1


def test_show_and_gold(spark, run):
    assert pipeline.show_model(spark, run["silver"], "fct_orders", 5).count() == 1
    assert pipeline.build_gold(spark, run["silver"], run["gold"]) == {
        "fct_orders": 0, "dim_customers_scd2": 0,
    }


def test_audit(spark, run):
    found = {r["source_table"]: tuple(r)[1:] for r in pipeline.audit_bronze(spark, run["bronze"]).collect()}
    assert found["customers"] == (4, 1, 1) and found["payments"] == (2, 1, 0)


def test_every_declared_check_passes(spark, run):
    report = pipeline.check_silver(spark, run["silver"])
    quality.enforce(report)
    assert report.count() == 26 + 8 + 3 + 4 + 6 + 4 + 2
    with_log = pipeline.check_silver(spark, run["silver"], run["bronze"])
    assert [r["passed"] for r in with_log.where("check = 'orders.status_chain'").collect()] == [True]
    assert pipeline.check_order_statuses(spark, run["bronze"]).isEmpty()


def test_a_table_without_events_keeps_its_silver(spark, run, tmp_path):
    landed, bronze, marks = (str(tmp_path / n) for n in ("landed", "bronze", "marks"))
    land(spark, landed, LOG[:4])
    finish(pipeline.start_ingest(
        file_messages(spark, landed), bronze, marks, ["customers", "orders"], jobs.ALL_THERE_IS
    ))
    written = pipeline.build_silver(spark, bronze, run["silver"])
    assert {n for n, v in written.items() if v is not None} == {"customers"}
    assert pipeline.read_silver(spark, run["silver"], "orders").count() == 1


def command(monkeypatch, *words):
    monkeypatch.setattr("sys.argv", ["tidemark", *words])
    main()


def test_command_line(spark, run, tmp_path, monkeypatch, capsys):
    silver, kept, gold, marks = (str(tmp_path / n) for n in ("silver", "kept", "gold", "marks"))
    command(monkeypatch, "silver", "--bronze", run["bronze"], "--silver", silver)
    command(
        monkeypatch, "follow", "--bronze", run["bronze"], "--silver", kept,
        "--checkpoints", marks, "--once",
    )
    for folder in (silver, kept):
        command(monkeypatch, "gold", "--silver", folder, "--gold", gold)
        command(monkeypatch, "show", "--silver", folder, "--select", "dim_customers_scd2")
        command(monkeypatch, "check", "--silver", folder)
    command(monkeypatch, "history", "--bronze", run["bronze"], "--gold", gold)
    versions = tables.read_current(spark, f"{gold}/dim_customers_history").orderBy("valid_from_ms", "customer_id")
    assert [tuple(r)[0::3] for r in versions.collect()] == [(1, "A", False), (2, "A", False), (1, "B", True)]
    command(monkeypatch, "audit", "--bronze", run["bronze"])
    text = capsys.readouterr().out
    assert "ann@x" in text and "customers.unique:email" in text
    assert tables.read_current(spark, f"{gold}/fct_orders").count() == 1
    with pytest.raises(SystemExit):
        command(monkeypatch, "show", "--silver", silver)


def test_a_failed_check_stops_the_run(spark, run, tmp_path, monkeypatch):
    silver = str(tmp_path / "silver")
    pipeline.build_silver(spark, run["bronze"], silver)
    orders = pipeline.read_silver(spark, silver, "orders")
    tables.replace(orders.withColumn("customer_id", orders["customer_id"] + 1), f"{silver}/orders")
    with pytest.raises(quality.GateFailed, match="orders.foreign_key:customer_id: 1 of 1"):
        command(monkeypatch, "check", "--silver", silver)


@pytest.fixture
def customers_only(spark, tmp_path):
    at = {n: str(tmp_path / n) for n in ("landed", "bronze", "silver", "kept", "gold", "marks")}
    land(spark, at["landed"], LOG[:4])
    finish(pipeline.start_ingest(
        file_messages(spark, at["landed"]), at["bronze"], at["marks"], ["customers"], jobs.ALL_THERE_IS
    ))
    return at


def test_one_table_is_enough(spark, customers_only, monkeypatch, capsys):
    at = customers_only
    command(monkeypatch, "silver", "--bronze", at["bronze"], "--silver", at["silver"])
    command(monkeypatch, "audit", "--bronze", at["bronze"])
    command(
        monkeypatch, "follow", "--bronze", at["bronze"], "--silver", at["kept"],
        "--checkpoints", at["marks"], "--once",
    )
    for folder in (at["silver"], at["kept"]):
        command(monkeypatch, "show", "--silver", folder, "--select", "stg_customers")
        command(monkeypatch, "show", "--silver", folder, "--select", "dim_customers_scd2")
        command(monkeypatch, "check", "--silver", folder, "--bronze", at["bronze"])
        command(monkeypatch, "gold", "--silver", folder, "--gold", at["gold"])
        command(monkeypatch, "compact", "--bronze", at["bronze"], "--before", "9999-01-01")
        assert set(pipeline.models(spark, folder)) == {"stg_customers", "dim_customers_scd2"}
    command(monkeypatch, "quarantine", "--bronze", at["bronze"])
    with pytest.raises(FileNotFoundError):
        command(monkeypatch, "show", "--silver", at["silver"], "--select", "fct_orders")
    assert "ann@x" in capsys.readouterr().out


def test_a_new_column_reaches_silver(spark, customers_only):
    """Values that came before the schema was widened, and a message that did not fit."""
    at = customers_only
    row = {"customer_id": 3, **CUSTOMER, "email": "c@x", "phone": "123"}
    wide = T.StructType([*TABLES["customers"].row.fields, T.StructField("phone", T.StringType())])
    land(spark, at["landed"], [("customers", "c", 7, row)], start=50)
    land(spark, at["landed"], [("customers", "c", 8, {**row, "customer_id": "x"})], start=51)
    finish(pipeline.start_ingest(
        file_messages(spark, at["landed"]), at["bronze"], at["marks"], ["customers"], jobs.ALL_THERE_IS
    ))
    pipeline.build_silver(spark, at["bronze"], at["silver"], ["customers"])
    assert "phone" not in pipeline.read_silver(spark, at["silver"], "customers").columns
    pipeline.build_silver(
        spark, at["bronze"], at["silver"], ["customers"], reparse=True, rows={"customers": wide}
    )
    found = pipeline.read_silver(spark, at["silver"], "customers")
    assert {(r["customer_id"], r["phone"]) for r in found.collect()} == {(1, None), (3, "123")}
    text = T.StructType([T.StructField("customer_id", T.StringType()), *wide.fields[1:]])
    again = pipeline.reread_bronze(spark, at["bronze"], "customers", text)
    assert "x" in {r["customer_id"] for r in again.collect()}
