"""Profiles of tables and of JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homelake.functions import parse_whole


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, row count and null count, from a single pass."""
    counts = [F.count(F.col(f"`{name}`")).alias(f"c{i}") for i, name in enumerate(df.columns)]
    totals = df.agg(F.count(F.lit(1)).alias("row_count"), *counts)
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("column_type"),
            F.col("row_count"),
            (F.col("row_count") - F.col(f"c{i}")).alias("null_count"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ])
    return totals.select(F.inline(rows))


def json_profile(df: DataFrame, json_col: str) -> DataFrame:
    """Keys of the JSON objects in a text column: (key, type, records).

    A list carries the type of its first element, as in ``list[text]``.  Texts that are no JSON object are skipped.
    """
    whole = parse_whole(F.col(json_col), "map<string,variant>")
    members = df.select(F.explode(whole).alias("key", "value"))
    first = F.try_variant_get("value", "$[0]", "variant")
    named = members.select(
        "key",
        F.when(_is_list(F.col("value")), F.when(first.isNull(), "list").otherwise(F.concat(
            F.lit("list["), _kind(first), F.lit("]"))))
        .otherwise(_kind(F.col("value")))
        .alias("type"),
    )
    return named.groupBy("key", "type").agg(F.count(F.lit(1)).alias("records"))


def _is_list(value):
    return F.schema_of_variant(value).startswith("ARRAY")


def _kind(value):
    shape = F.schema_of_variant(value)
    return (
        F.when(shape.startswith("OBJECT"), "object")
        .when(shape.startswith("ARRAY"), "list")
        .when(shape == "STRING", "text")
        .when(shape == "BOOLEAN", "flag")
        .when(shape == "BIGINT", "whole")
        .when(shape == "VOID", "null")
        .otherwise("number")
    )
