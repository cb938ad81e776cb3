"""Nested arrays to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_series(df: DataFrame, keys: list[str], array: str, alias: str = "point") -> DataFrame:
    """One row per array element; rows with an empty or missing array disappear."""
    return df.select(*keys, F.explode(array).alias(alias))


def explode_nested(
    df: DataFrame, keys: list[str], outer: str, inner: str, keep_outer=None, names: tuple[str, str] = ("outer", "inner")
) -> DataFrame:
    """Two levels of nesting to rows: (keys, outer element, inner element).

    ``keep_outer`` is a test on the outer element, applied before it is exploded.  An outer element without
    inner ones stays, with a null inner element.
    """
    elements = F.filter(outer, keep_outer) if keep_outer else F.col(outer)
    outer_rows = df.select(*keys, F.explode(elements).alias(names[0]))
    return outer_rows.select(*keys, names[0], F.explode_outer(f"{names[0]}.{inner}").alias(names[1]))


def quality_items(
    df: DataFrame, key: str, outer: str, inner: str, parent_type: str, names: tuple[str, str, str, str]
) -> DataFrame:
    """Items of the outer elements of one parent type: (key, item id, item name, code of the outer element).

    Id and name fall back to those of the outer element, each on its own.
    """
    rows = explode_nested(df, [key], outer, inner, lambda q: q["parent_type"] == parent_type, ("q", "a"))
    return rows.select(
        F.col(key).alias(names[0]),
        F.coalesce("a.id", "q.id").alias(names[1]),
        F.coalesce("a.name", "q.name").alias(names[2]),
        F.col("q.code").alias(names[3]),
    )


def attach_parent(df: DataFrame, parent: str, children: str, field: str, alias: str = "child") -> DataFrame:
    """One row per child struct, carrying its parent's key in ``field``."""
    rows = df.select(F.col(parent).alias("__parent"), F.explode(children).alias(alias))
    return rows.select(F.col(alias).withField(field, F.col("__parent")).alias(alias)).select(f"{alias}.*")
