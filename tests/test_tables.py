import os
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import session
from tidemark.operators import quality
from tidemark.sources import buckets, keysets, tables


def test_append_widens_the_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append(spark.createDataFrame([(1, "a")], "k int, a string"), path)
    tables.append(spark.createDataFrame([(2, 0.5)], "k int, b double"), path)
    found = {(r["k"], r["a"], r["b"]) for r in tables.read(spark, path).collect()}
    assert found == {(1, "a", None), (2, None, 0.5)}


def changes(spark, *rows):
    return spark.createDataFrame(rows, "k int, ts bigint, seq int, op string")


def test_replace_changes_data_and_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not tables.exists(spark, path)
    with pytest.raises(FileNotFoundError):
        tables.read_current(spark, path)
    assert tables.replace(spark.range(3).toDF("a"), path) == 0
    assert tables.replace(spark.range(2).toDF("b"), path) == 1
    now = tables.read_current(spark, path)
    assert now.columns == ["b"] and now.count() == 2


def test_a_table_can_be_replaced_by_a_query_over_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(spark.range(3), path)
    tables.replace(tables.read_current(spark, path).selectExpr("id + 10 as id"), path)
    assert sorted(r["id"] for r in tables.read_current(spark, path).collect()) == [10, 11, 12]


def test_an_unfinished_version_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(spark.range(3), path)
    tables.replace(spark.range(9), path)
    os.remove(f"{path}/v-000000000001/_SUCCESS")
    assert tables.read_current(spark, path).count() == 3
    assert tables.replace(spark.range(5), path) == 1
    assert tables.read_current(spark, path).count() == 5


def changes(spark, *rows):
    return spark.createDataFrame(rows, "k int, ts bigint, seq int, op string")


ARGS = {"keys": "k", "ts": "ts", "seq": "seq"}


def test_state_by_bucket(spark, tmp_path):
    path = str(tmp_path / "t")
    assert buckets.read_state(spark, path) is None

    def state():
        return {tuple(r) for r in buckets.read_state(spark, path).collect()}

    buckets.upsert(changes(spark, (1, 5, 0, "c"), (2, 5, 1, "d"), (1, 3, 9, "u")), path, **ARGS, buckets=8)
    late = changes(spark, (2, 4, 2, "u"), (1, 6, 3, "u"))
    for _ in range(2):
        buckets.upsert(late, path, **ARGS, buckets=99)  # the first batch decides
    assert state() == {(1, 6, 3, "u"), (2, 5, 1, "d")}
    buckets.upsert(changes(spark, (None, 2, 7, "u"), (None, 1, 8, "u"), (1, 7, 8, "d")), path, **ARGS)
    assert state() == {(1, 7, 8, "d"), (2, 5, 1, "d"), (None, 2, 7, "u")}
    assert buckets.upsert(changes(spark).limit(0), path, **ARGS) == []
    wider = changes(spark, (3, 1, 1, "c")).selectExpr("CAST(k AS BIGINT) AS k", "ts", "seq", "op", "'x' AS more")
    narrow = wider.selectExpr("CAST(k AS INT) AS k", "ts", "seq", "op", "more")
    buckets.upsert(narrow, path, **ARGS)
    assert {r["more"] for r in buckets.read_state(spark, path).collect()} == {None, "x"}


def test_buckets_without_changes_keep_their_files(spark, tmp_path):
    """A batch rewrites the buckets of its keys, each to one file, and no others."""
    path = str(tmp_path / "t")
    base = spark.range(20_000).selectExpr("cast(id as int) k", "1L ts", "cast(id as int) seq", "'c' op")
    buckets.upsert(base, path, **ARGS, buckets=16)

    def files():
        return {f: os.stat(f).st_mtime_ns for f in map(str, Path(path).rglob("*.parquet"))}

    before = files()
    assert len(before) == 16
    touched = buckets.upsert(changes(spark, (3, 2, 1, "u"), (4, 2, 2, "d")), path, **ARGS)
    after = files()
    assert len(after) == 16 and len(before.items() - after.items()) == len(touched) <= 2
    same = {f for f in before if f in after}
    assert all(f"bucket_of_16={t}/" not in f for f in same for t in touched)
    found = buckets.read_state(spark, path)
    assert found.count() == 20_000 and found.where("ts = 2").count() == 2


def test_appends_that_differ_in_type(spark, tmp_path):
    path = str(tmp_path / "t")
    for row, schema in (
        ((1, 2, 1.5, date(2024, 1, 2), "x", (1, "a")), "k int, n int, d double, t date, s string, r struct<a:int,b:string>"),
        ((2**40, 0.5, 2, datetime(2024, 1, 2, 3), 7, (2**40, "b")), "k bigint, n double, d int, t timestamp, s int, r struct<a:bigint,b:string>"),
    ):
        tables.append(spark.createDataFrame([row], schema), path)
    tables.append(spark.createDataFrame([(3, Decimal("1.25"))], "k smallint, n decimal(20,2)"), path)
    tables.append(spark.createDataFrame([("y", True)], "s string, n boolean"), path)
    found = tables.read(spark, path)
    kinds = dict(found.dtypes)
    assert (kinds["k"], kinds["d"], kinds["t"], kinds["s"]) == ("bigint", "double", "timestamp", "string")
    assert kinds["r"] == "struct<a:bigint,b:string>"
    assert {c for c in kinds if "_as_" in c} == {
        "s_as_string", "s_as_int", "n_as_int", "n_as_double", "n_as_decimal", "n_as_boolean"
    }
    by_key = {r["k"]: r for r in found.collect()}
    assert (by_key[1]["n"], by_key[1]["n_as_int"], by_key[2**40]["s"], by_key[2**40]["s_as_int"]) == ("2", 2, "7", 7)
    assert by_key[1]["t"] == datetime(2024, 1, 2) and by_key[3]["n_as_decimal"] == Decimal("1.25")
    assert by_key[None]["n"] == "true" and by_key[None]["r"] is None
    assert len(tables.folders(spark, path)) == 4
    with pytest.raises(FileNotFoundError):
        tables.read(spark, str(tmp_path / "none"))


@pytest.mark.parametrize(
    "a, b, both",
    [
        (T.IntegerType(), T.LongType(), T.LongType()),
        (T.LongType(), T.DoubleType(), T.DoubleType()),
        (T.IntegerType(), T.DecimalType(10, 2), T.DecimalType(12, 2)),
        (T.LongType(), T.DecimalType(38, 30), None),
        (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
        (T.TimestampType(), T.TimestampNTZType(), T.TimestampType()),
        (T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType()), T.ArrayType(T.LongType())),
        (T.StringType(), T.LongType(), None),
        (T.NullType(), T.StringType(), T.StringType()),
    ],
)
def test_common_types(a, b, both):
    assert tables.common_type(a, b) == both == tables.common_type(b, a)


def test_a_version_that_fails_its_gate_is_not_published(spark, tmp_path):
    path = str(tmp_path / "t")
    rules = {"small": F.col("id") > 100, "not_null": F.col("id").isNull()}
    number, report = tables.publish(spark.range(10), path, rules)
    assert number == 0 and {tuple(r) for r in report.collect()} == {
        ("small", 10, 0, True), ("not_null", 10, 0, True)
    }
    number, report = tables.publish(spark.range(105), path, rules)
    assert number is None and [tuple(r) for r in report.where("NOT passed").collect()] == [
        ("small", 105, 4, False)
    ]
    assert tables.read_current(spark, path).count() == 10
    with pytest.raises(quality.GateFailed, match="small: 4 of 105"):
        quality.enforce(report)
    assert tables.publish(spark.range(20), path, rules)[0] == 1
    assert tables.publish(spark.range(0), path, rules)[0] == 2
    assert tables.read_current(spark, path).count() == 0


def test_key_sets(spark, tmp_path):
    path = str(tmp_path / "keys")
    keys = [1, 2, 0, -1, -5, 32768, 32769, 32767, 10**15, -(10**12), 8, 9, 7]
    frame = spark.createDataFrame([(k,) for k in keys + [None]], "k bigint")
    keysets.add_keys(frame, "k", path)
    keysets.add_keys(frame, "k", path)
    asked = keys + [k + 1 for k in keys] + [k - 1 for k in keys] + [None]
    batch = spark.createDataFrame([(k, "x") for k in asked], "k bigint, bucket string")
    found = keysets.with_membership(batch, "k", keysets.read_set(spark, path), "known")
    assert found.columns == ["k", "bucket", "known"]
    for r in found.collect():
        assert r["known"] == (None if r["k"] is None else r["k"] in keys)
    assert keysets.set_size(keysets.read_set(spark, path)).first()["keys"] == len(keys)
    assert keysets.orphans(batch, "k", keysets.read_set(spark, str(tmp_path / "none"))).count() == 3 * len(keys)
    twice = spark.createDataFrame([(100,), (100,), (200,), (2,), (None,), (None,)], "k int")
    repeated = keysets.repeated_keys(twice, "k", keysets.read_set(spark, path))
    assert sorted(r["k"] for r in repeated.collect()) == [2, 100]
    keysets.add_keys(twice.limit(0), "k", path)
    assert keysets.read_set(spark, path).count() == keysets.key_set(frame, "k").count()


def test_settings_hold_for_a_block_only(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    for stored, partitions in (
        (0, 8),
        (100 * session.PARTITION_BYTES, 101),
        (100 * 2**40, 100 * 2**40 // session.PARTITION_BYTES + 1),
    ):
        with session.sized_shuffles(spark, stored):
            assert spark.conf.get(name) == str(partitions)
        assert spark.conf.get(name) == before
    with pytest.raises(ValueError), session.settings_for(spark, {"tidemark.none": "1"}):
        raise ValueError
    assert spark.conf.get("tidemark.none", None) is None
