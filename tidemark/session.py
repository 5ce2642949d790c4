"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_session(app: str = "tidemark") -> SparkSession:
    """The running session, or a new one with the settings the jobs expect."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Settings that results depend on: wall-clock source times are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# Stored bytes per shuffle partition.
PARTITION_BYTES = 128 * 1024 * 1024


@contextmanager
def settings_for(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings that hold for a block and are as before afterwards."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@contextmanager
def sized_shuffles(spark: SparkSession, stored_bytes: int) -> Iterator[None]:
    """Start shuffles of a block with enough partitions for an input of ``stored_bytes``.

    The default of 200 would put hundreds of gigabytes of a large table into one task.
    Adaptive execution merges partitions that turn out small, so too many do no harm.
    """
    wanted = max(stored_bytes // PARTITION_BYTES + 1, spark.sparkContext.defaultParallelism)
    with settings_for(spark, {"spark.sql.shuffle.partitions": str(wanted)}):
        yield


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for checkpoints and intermediate tables.

    On a cluster it lies in the shared folder named by ``spark.checkpoint.dir``; a
    machine-local folder is used only by a local session that names none.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
