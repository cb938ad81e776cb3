"""Session settings and lineage cutting shared by the jobs, the bench and the tests."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Settings the builders rely on.  Parallelism, memory and the broadcast threshold stay with the cluster.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the Python line of every column expression costs a JVM call each; wide tables have hundreds.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**ENGINE_CONF, **(conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


_STORED: list[str] = []


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="homelake-")


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names.  Only a local session may go without one (tests) and gets a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir (--work-dir of the jobs)")
    return named or _own_folder()


@contextmanager
def work_tables(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end of the block, the tables that :func:`cut_lineage` stored in it; for a block that also reads its results."""
    before = len(_STORED)
    try:
        yield
    finally:
        remove_stored(spark, before)


def remove_stored(spark: SparkSession, before: int = 0) -> None:
    """Delete the tables that :func:`cut_lineage` stored, but for the first ``before``; for the end of a job, when nothing reads them any more."""
    while len(_STORED) > before:
        path = spark._jvm.org.apache.hadoop.fs.Path(_STORED.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame, **options: str | int) -> DataFrame:
    """Store an intermediate result as a table in the shared folder and read it from there.

    It is computed once, survives lost executors, and later steps read only the columns they need.  ``options`` are those of Spark's Parquet writer.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/table-{uuid4().hex}"
    df.write.options(**options).parquet(path)
    _STORED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_result(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """Store what ``build`` returns and delete the tables that were stored on the way to it."""
    before = len(_STORED)
    result = cut_lineage(build())
    kept = _STORED.pop()
    remove_stored(spark, before)
    _STORED.append(kept)
    return result
