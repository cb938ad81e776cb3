"""Identifier lists and record fallback."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from homelake.functions import lowered
from homelake.operators.joins import lookup_join

_FOUND = "__found"


def present_key(key: Column) -> Column:
    """False for a missing or empty identifier; see :func:`json_key` and :func:`column_key` for zero and false."""
    return F.coalesce(key != "", F.lit(False))


def json_key(record: Column, name: str) -> Column:
    """Member ``name`` of a JSON record as identifier text: null where missing, empty where it is the number zero or false.

    The text ``"0"`` is an identifier; only the JSON value tells it from the number.
    """
    text = F.get_json_object(record, f"$.{name}")
    number, flag = F.from_json(record, f"`{name}` double")[name], F.from_json(record, f"`{name}` boolean")[name]
    return F.when((number == 0) | ~flag, F.lit("")).otherwise(text)


def column_key(df: DataFrame, name: str) -> Column:
    """Column ``name`` as identifier text; empty where it is the number zero."""
    text = F.col(name).cast("string")
    return F.when(F.col(name) == 0, F.lit("")).otherwise(text) if isinstance(df.schema[name].dataType, NumericType) else text


def not_containing(text: Column, word: str) -> Column:
    """Case-insensitive; a missing text contains nothing."""
    return ~lowered(text).contains(word)


def collect_keys(sources: list[tuple[DataFrame, list[str]]], visited: DataFrame, out: str) -> DataFrame:
    """Distinct usable identifiers of several tables that are not in ``visited`` (a table with column ``out``).

    Each table's identifier is its first non-null candidate column.
    """
    keys = reduce(
        DataFrame.unionByName,
        [df.select(F.coalesce(*[column_key(df, name) for name in names]).alias(out)) for df, names in sources],
    )
    distinct = keys.where(present_key(F.col(out))).distinct()
    return distinct.join(visited.select(F.col(out).cast("string")).distinct(), out, "left_anti")


def with_fallback(base: DataFrame, detail: DataFrame, key: str, spread_by: list[str]) -> DataFrame:
    """Detail record per base row, or the whole base record where no detail exists.

    ``detail`` has one row per key.  The result has the columns of both; a column only one side knows is null when
    the record comes from the other side.
    """
    names = list(dict.fromkeys([*base.columns, *detail.columns]))
    fields = [name for name in detail.columns if name != key]
    tagged = detail.select(key, *[F.col(n).alias(f"__d_{n}") for n in fields], F.lit(True).alias(_FOUND))
    both = lookup_join(base, tagged, key, spread_by)

    def pick(name: str) -> Column:
        if name == key:
            return F.col(name)
        detail_side = F.col(f"__d_{name}") if name in fields else F.lit(None)
        base_side = F.col(name) if name in base.columns else F.lit(None)
        return F.when(F.col(_FOUND), detail_side).otherwise(base_side).alias(name)

    return both.select([pick(name) for name in names])
