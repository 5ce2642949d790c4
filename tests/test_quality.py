import logs
import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.schemas import CUSTOMERS, TABLES


def test_row_rules_cover_the_declared_constraints(spark):
    rules = {n: set(quality.row_rules(t, t.row.fieldNames())) for n, t in TABLES.items()}
    assert {"not_null:email", "length:country"} <= rules["customers"]
    assert "accepted:order_status" in rules["orders"]
    assert "decimal:amount" in rules["payments"]
    kinds = [name.split(":")[0] for names in rules.values() for name in names]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 26, "length": 8, "decimal": 3, "accepted": 4,
    }


def test_rules_are_built_for_the_columns_at_hand(spark):
    assert set(quality.row_rules(CUSTOMERS, ["email"])) == {"not_null:email", "length:email"}


def test_violations_of_one_row_are_listed_each(spark):
    df = spark.createDataFrame(
        [(1, None, "x" * 6), (2, "ok", "ok"), (3, "no", None)], "id int, a string, b string"
    )
    rules = {
        "null": quality.null_rule("a"),
        "long": quality.length_rule("b", 5),
        "domain": quality.accepted_rule("a", ["ok"]),
    }
    found = sorted(map(tuple, quality.violations(df, rules, ["id"]).collect()))
    assert found == [(1, "long"), (1, "null"), (3, "domain")]
    summary = {r["check"]: r["rows_failed"] for r in quality.summarize(df, rules, "t").collect()}
    assert summary == {"t.null": 1, "t.long": 1, "t.domain": 1}


@pytest.mark.parametrize(
    "value, bad",
    [(1.25, False), (99999999.99, False), (-99999999.99, False), (100000000.0, True), (1.255, True), (None, False), (1e30, True)],
)
def test_money_fits(spark, value, bad):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(quality.money_rule("v")).first()[0] is bad


def test_unique_does_not_count_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "e string")
    assert [tuple(r) for r in quality.check_unique(df, "e").collect()] == [("a", 2)]


def test_status_moves_one_step(spark):
    steps = ["PENDING", "PAID", "PAID", "SHIPPED", "CANCELLED", "DELIVERED", None, "PENDING"]
    rows = [(0, 1, i, i, "u", s) for i, s in enumerate(steps)]
    df = spark.createDataFrame(rows, logs.SCHEMA)
    bad = quality.check_transitions(df, "k", "v", "ts", "seq")
    assert sorted(r["seq"] for r in bad.collect()) == [4, 5, 6]


def test_gate(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    ok = quality.summarize(df, {"any": F.lit(False)}, "t")
    bad = quality.count_violations(df, df.where("a is null"), "t.null")
    report = quality.gate([ok, bad])
    assert {tuple(r) for r in report.collect()} == {("t.any", 2, 0, True), ("t.null", 2, 1, False)}
    quality.enforce(quality.gate([ok]))
    with pytest.raises(quality.GateFailed, match="t.null: 1 of 2"):
        quality.enforce(report)
    empty = quality.count_violations(df.limit(0), df.limit(0), "none")
    assert tuple(empty.first()) == ("none", 0, 0)


def test_set_checks_counted_in_one_pass(spark):
    """The same numbers as the rows that the checks return."""
    rows = [(1, "a"), (1, "a"), (2, None), (3, "z"), (None, "b"), (None, "b"), (4, "z")]
    child = spark.createDataFrame(rows, "k int, ref string")
    parent = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string")
    for df in (child, child.limit(0)):
        found = quality.summarize_unique(df, "k", "u").first()
        assert tuple(found) == ("u", df.count(), quality.check_unique(df, "k").count())
        found = quality.summarize_foreign_key(df, "ref", parent, "id", "f").first()
        assert tuple(found) == ("f", df.count(), quality.check_foreign_key(df, "ref", parent, "id").count())
