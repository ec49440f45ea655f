"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_scratch(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="tallyforge-")


def shared_dir(spark: SparkSession) -> str:
    """A new sub-folder of the folder every executor can reach.

    It is the one the cluster names in ``spark.checkpoint.dir``.  Only a local
    master, where driver and executors are one process, may fall back to a
    temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_scratch(spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/tallyforge-{uuid.uuid4().hex}"


def stored(table: DataFrame) -> DataFrame:
    """The table written to the shared folder and read from there.

    For results that several later plans read: they are computed once, survive a
    lost executor, and Spark knows their size.
    """
    path = shared_dir(table.sparkSession)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


@contextmanager
def configured(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for what is run within."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_dropped(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of what is run within go when it ends, not when the driver's garbage is next collected.

    For tables that are written and read from there, so that no later run looks for the files.
    """
    return configured(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
