"""Tables on shared storage: append, replace by version, publish behind a gate.

A table that is replaced lives under ``path`` as one folder per version. A version counts
once it holds ``_SUCCESS``, which is written last, so a reader never sees a half-written one
and a job may read the version before while it writes the next. One writer per table.

A table that grows by appends has one folder per column layout, named by a digest of it. Files
of one layout are read together, whatever their number, and each layout is cast once to
the types that all of them have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import settings_for

FORMAT = "parquet"
LAYOUT = "layout-"


# -- appended tables -----------------------------------------------------------------


def _layout(schema: T.StructType) -> str:
    """A digest of column names and types; the order of columns and their nullability are free."""
    fields = sorted((f.name, f.dataType.simpleString()) for f in schema.fields)
    return LAYOUT + hashlib.sha256(repr(fields).encode()).hexdigest()[:16]


def append(df: DataFrame, path: str, fmt: str = FORMAT, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a table; their columns and types may differ from those already there."""
    folder = f"{path}/{_layout(df.schema)}"
    df.write.mode("append").format(fmt).partitionBy(*partition_by).save(folder)


_INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def _digits(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point of an exact number."""
    if kind in _INTEGERS:
        return (3, 5, 10, 19)[_INTEGERS.index(kind)], 0
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return None


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds the values of both; None if only text would.

    Integers widen to the larger one, an integer and a decimal to a decimal if 38 digits do,
    and any of them beside a float to double; a date beside a timestamp is its midnight.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _INTEGERS and b in _INTEGERS:
        return max(a, b, key=_INTEGERS.index)
    floats = (T.FloatType, T.DoubleType)
    x, y = _digits(a), _digits(b)
    if x and y:
        before, after = max(x[0], y[0]), max(x[1], y[1])
        return T.DecimalType(before + after, after) if before + after <= 38 else None
    if (x or isinstance(a, floats)) and (y or isinstance(b, floats)):
        return T.DoubleType()
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        kinds = {type(a), type(b)} - {T.DateType}
        return kinds.pop()() if len(kinds) == 1 else T.TimestampType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _common_struct(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = common_type(a.elementType, b.elementType)
        return element and T.ArrayType(element)
    return None


def _common_struct(a: T.StructType, b: T.StructType) -> T.StructType | None:
    if a.fieldNames() != b.fieldNames():
        return None
    kinds = [common_type(x.dataType, y.dataType) for x, y in zip(a, b)]
    if None in kinds:
        return None
    return T.StructType([T.StructField(f.name, kind) for f, kind in zip(a, kinds)])


def _text(col: Column, kind: T.DataType) -> Column:
    return F.to_json(col) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else col.cast("string")


def union_drifted(parts: Sequence[DataFrame]) -> DataFrame:
    """The rows of tables whose columns differ in presence or type.

    A column that a table lacks is null there. One whose types have a common type (see
    ``common_type``) has that. Any other column is text, and beside it ``<name>_as_<type>`` holds
    the values as they were, null in rows of other types. Columns come in the order of their
    first appearance; each table is cast once.
    """
    kinds: dict[str, list[T.DataType]] = {}
    for part in parts:
        for f in part.schema.fields:
            seen = kinds.setdefault(f.name, [])
            if f.dataType not in seen:
                seen.append(f.dataType)
    plain = {c: reduce(lambda a, b: a and common_type(a, b), seen) for c, seen in kinds.items()}

    def beside(c: str, kind: T.DataType) -> str:
        return f"{c}_as_{kind.simpleString().partition('<')[0].partition('(')[0]}"

    out = []
    for part in parts:
        have = {f.name: f.dataType for f in part.schema.fields}
        columns = []
        for c, target in plain.items():
            own = F.col(f"`{c}`") if c in have else F.lit(None)
            if target:
                columns.append(own.cast(target).alias(c))
                continue
            columns.append((_text(own, have[c]) if c in have else own.cast("string")).alias(c))
            for kind in kinds[c]:
                same = c in have and have[c] == kind
                columns.append((own if same else F.lit(None).cast(kind)).alias(beside(c, kind)))
        out.append(part.select(*columns))
    return reduce(DataFrame.unionByName, out)


def read(spark: SparkSession, path: str, fmt: str = FORMAT) -> DataFrame:
    """All rows of an appended table, in the types its layouts have in common.

    Reads one footer per layout. Files right under ``path``, which something else has put
    there, are one more layout. Raises FileNotFoundError where there is no table.
    """
    found = [n for n in sorted(folders(spark, path)) if n.startswith(LAYOUT)]
    roots = [f"{path}/{n}" for n in found]
    if not roots or has_files(spark, path):
        roots.append(path)
    if not exists(spark, path):
        raise FileNotFoundError(f"no table under {path}")
    load = spark.read.format(fmt)
    return union_drifted([load.load(r) for r in roots])


# -- replaced tables -----------------------------------------------------------------


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished versions, oldest first."""
    found = _status(spark, f"{path}/v-*/_SUCCESS")
    return sorted(int(s.getPath().getParent().getName().removeprefix("v-")) for s in found)


def has_versions(spark: SparkSession, path: str) -> bool:
    """Whether a replaced table has a finished version."""
    return bool(_versions(spark, path))


def _name(path: str, number: int) -> str:
    return f"{path}/v-{number:012d}"


def _next(spark: SparkSession, path: str) -> int:
    return max(_versions(spark, path), default=-1) + 1


def replace(df: DataFrame, path: str, fmt: str = FORMAT) -> int:
    """Put ``df``, data and columns, in place of the table; returns the version number."""
    number = _next(df.sparkSession, path)
    df.write.mode("overwrite").format(fmt).save(_name(path, number))
    return number


def read_current(spark: SparkSession, path: str, fmt: str = FORMAT) -> DataFrame:
    """The newest finished version of a replaced table."""
    done = _versions(spark, path)
    if not done:
        raise FileNotFoundError(f"no finished version under {path}")
    return spark.read.format(fmt).load(_name(path, done[-1]))


def publish(
    df: DataFrame, path: str, rules: dict[str, Column], fmt: str = FORMAT
) -> tuple[int | None, DataFrame]:
    """Write, audit and publish in one pass: (version or None, report).

    A rule is true of a row that breaks it. Rows and breaches are counted while the new version
    is written; it gets its ``_SUCCESS``, and so becomes the table, only if no row broke a
    rule. Else the version before stays current, and the rejected one lies beside it, unread,
    until the next write takes its number. The report has check, rows_checked, rows_failed and
    passed, like ``quality.gate``.
    """
    spark = df.sparkSession
    number = _next(spark, path)
    counts = [F.count_if(rule).alias(f"f{i}") for i, rule in enumerate(rules.values())]
    seen = Observation()
    (
        df.observe(seen, F.count(F.lit(1)).alias("n"), *counts)
        .write.mode("overwrite")
        .format(fmt)
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        .save(_name(path, number))
    )
    found = seen.get
    rows = [(name, found["n"], found[f"f{i}"], found[f"f{i}"] == 0) for i, name in enumerate(rules)]
    report = spark.createDataFrame(
        rows, "check string, rows_checked long, rows_failed long, passed boolean"
    )
    if not all(r[3] for r in rows):
        return None, report
    marker, files = _folder(spark, f"{_name(path, number)}/_SUCCESS")
    files.create(marker).close()
    return number, report


# -- tables of partitions -------------------------------------------------------------

# Partitions that a task writes side by side as its rows come; rows of any more are sorted first.
WRITERS = 2


def overwrite_partitions(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Write rows in place of the partitions that they fall in; all others stay as they are."""
    with settings_for(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(WRITERS)}):
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*columns)
            .parquet(path)
        )


def _staged(path: str) -> str:
    return f"{path.rstrip('/')}-staged"


def stage(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Write what is to be swapped into the partitions of a table beside it.

    The rows may come from the table itself. ``swap`` makes them part of it.
    """
    df.write.mode("overwrite").partitionBy(*columns).parquet(_staged(path))


def swap(spark: SparkSession, path: str, columns: Sequence[str]) -> list[tuple[str, ...]]:
    """Put partitions that are staged completely in place; returns their values.

    Swapping folders is not one step, but it can be repeated: the staged rows go last. So a
    writer calls this before it reads a table, too, which finishes what one that died began.
    """
    staged = _staged(path)
    if not exists(spark, f"{staged}/_SUCCESS"):
        return []
    found = [()]
    for _ in columns:
        found = [
            (*f, name) for f in found for name in folders(spark, "/".join((staged, *f))) if "=" in name
        ]
    if found:
        overwrite_partitions(read_partitions(spark, staged), path, columns)
    remove(spark, staged)
    return [tuple(n.partition("=")[2] for n in f) for f in found]


def read_partitions(spark: SparkSession, path: str) -> DataFrame:
    """A partitioned table with the columns of all its files."""
    return spark.read.option("mergeSchema", "true").parquet(path)


# -- files -----------------------------------------------------------------------------


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _status(spark: SparkSession, pattern: str) -> list:
    path, files = _folder(spark, pattern)
    return list(files.globStatus(path) or [])


def exists(spark: SparkSession, path: str) -> bool:
    folder, files = _folder(spark, path)
    return files.exists(folder)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right under ``path``."""
    return [s.getPath().getName() for s in _status(spark, f"{path}/*") if s.isDirectory()]


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether data lies under ``path`` outside the folders of layouts."""
    names = [s.getPath().getName() for s in _status(spark, f"{path}/*")]
    return any(not n.startswith((LAYOUT, "_", ".")) for n in names)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with what is in it."""
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes stored under ``path``."""
    folder, files = _folder(spark, path)
    return files.getContentSummary(folder).getLength()
