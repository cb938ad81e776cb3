"""Declarative flattening of nested records: output name, source path and kind of cast."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homelake.functions import epoch_day_text, joined, lenient_date, nth, round_to


class Out(NamedTuple):
    """One output column.  ``source`` defaults to the column of the same name; ``nth`` is a 1-based index."""

    name: str
    kind: str = "keep"
    source: str | None = None
    nth: int | None = None


_KINDS = {
    "keep": lambda c: c,
    "text": lambda c: c.cast("string"),
    "long": lambda c: round_to(c, "bigint"),
    "int": lambda c: round_to(c, "int"),
    "double": lambda c: c.cast("double"),
    "date": lenient_date,
    "joined": joined,
    "epoch_day": epoch_day_text,
}


def _column(out: Out) -> Column:
    value = F.col(out.source or out.name)
    if out.nth is not None:
        value = nth(value, out.nth)
    return _KINDS[out.kind](value).alias(out.name)


def project_spec(df: DataFrame, spec: list[Out]) -> DataFrame:
    return df.select([_column(out) for out in spec])
