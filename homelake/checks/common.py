"""Helpers of the checks."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Check(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


@lru_cache(maxsize=None)
def _schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Test table; its schema is looked up once per session, so later queries start without reading a footer."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def steady(value: str | Column, digits: int = 4) -> Column:
    """Rounding that float summation order cannot tip over: exact ties are moved off the tie first."""
    return F.round((F.col(value) if isinstance(value, str) else value) + 1e-7, digits)


def steadied(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    return df.withColumns({name: steady(name, digits) for name in names})
