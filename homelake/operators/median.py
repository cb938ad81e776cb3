"""Exact grouped median that never gathers a large group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
ACCURACY = 100_000
_VALUE, _EDGES, _ROWS = "__value", "__edges", "__rows"


def exact_median(
    df: DataFrame,
    dims: list[str],
    value: Column,
    out: str,
    others: dict[str, Column] | None = None,
    hot_rows: int = HOT_ROWS,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Interpolated median of ``value`` per group of ``dims``, next to ``others`` (aggregates of the same rows).

    The rows are read twice.  The first pass counts each group and brackets its median by approximate quantiles.  In the
    second, values outside the bracket of a group of more than ``hot_rows`` rows are pulled to its edge, which moves no middle
    value, so the exact percentile has about 20 / ``accuracy`` of such a group's values to hold; other groups have no bracket.

    All aggregates combine before the exchange and no row is shuffled on its own.  The broadcast holds at most one entry per bracketed
    group, that is rows / ``hot_rows`` entries.
    """
    plain = [agg.alias(name) for name, agg in (others or {}).items()]
    known = df.withColumn(_VALUE, value.cast("double")).where(F.col(_VALUE).isNotNull())
    margin = 10 / accuracy
    edges = known.groupBy(*dims).agg(
        F.count(F.lit(1)).alias(_ROWS), F.percentile_approx(_VALUE, [0.5 - margin, 0.5 + margin], accuracy).alias(_EDGES)
    )
    rows = _matched(known, edges.where(F.col(_ROWS) > hot_rows).select(*dims, _EDGES), dims)
    low, high, here = F.col(_EDGES)[0], F.col(_EDGES)[1], F.col(_VALUE)
    clipped = F.when(low.isNull(), here).otherwise(F.least(F.greatest(here, low), high))
    half = (F.count(here) - 1) / 2
    # The quantiles are off by at most 1 / accuracy of the rows, a tenth of the margin.
    bracketed = (F.count_if(here < low) <= half) & (F.count_if(here > high) <= half)
    checked = F.when(bracketed, F.percentile(clipped, F.lit(0.5))).otherwise(F.raise_error(F.lit("median outside its bracket")))
    return rows.groupBy(*dims).agg(*plain, checked.alias(out))


def _matched(left: DataFrame, right: DataFrame, dims: list[str]) -> DataFrame:
    """Left join with the few bracketed groups; a missing group key equals a missing one."""
    names = {name: f"__of_{name}" for name in dims}
    same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(other)) for name, other in names.items()])
    return left.join(F.broadcast(right.withColumnsRenamed(names)), same, "left").drop(*names.values())
