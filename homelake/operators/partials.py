"""Aggregates in two steps: states of parts of the rows, and states merged to the aggregate of all rows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Measure(NamedTuple):
    """An aggregate that is a merge of partial ones: ``kind`` is count (of known values), sum, min, max or avg."""

    kind: str
    value: Column


_PARTIAL = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def partial_states(df: DataFrame, dims: list[str], measures: dict[str, Measure]) -> DataFrame:
    """One row per group with a state per measure; a mean is kept as its sum and its count."""
    states = []
    for name, (kind, value) in measures.items():
        if kind == "avg":
            states += [F.sum(value.cast("double")).alias(f"{name}__sum"), F.count(value).alias(f"{name}__count")]
        else:
            states.append(_PARTIAL[kind](value).alias(name))
    return df.groupBy(*dims).agg(*states)


def merge_states(states: DataFrame, dims: list[str], measures: dict[str, Measure]) -> DataFrame:
    """Aggregates of all rows from the states of their parts."""
    merged = []
    for name, (kind, _) in measures.items():
        if kind == "avg":
            merged.append(F.try_divide(F.sum(f"{name}__sum"), F.sum(f"{name}__count")).alias(name))
        else:
            merged.append(_MERGE[kind](name).alias(name))
    return states.groupBy(*dims).agg(*merged)
