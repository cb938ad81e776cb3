"""Grouped summaries.  All aggregates combine before the exchange, so hot groups cost one row per task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homelake.functions import contains_any, round_to_grid
from homelake.operators.joins import lookup_join


def summary_by(df: DataFrame, dims: list[str], aggs: dict[str, Column], where: Column | None = None) -> DataFrame:
    """Aggregates per group of ``dims``, over the rows that pass ``where``."""
    rows = df if where is None else df.where(where)
    return rows.groupBy(*dims).agg(*[agg.alias(name) for name, agg in aggs.items()])


def conditional_counts(
    df: DataFrame, dims: list[str], flags: dict[str, Column], aggs: dict[str, Column] | None = None
) -> DataFrame:
    """Rows per group that satisfy each flag (an unknown flag does not), next to other aggregates."""
    return summary_by(df, dims, {**(aggs or {}), **{name: F.count_if(test) for name, test in flags.items()}})


def bin_label(value: Column, bins: Sequence[tuple[Callable[[Column], Column], str]], last: str) -> Column:
    """Label of the first bin whose test holds, else ``last``."""
    (test, label), *more = bins
    chosen = F.when(test(value), label)
    for test, label in more:
        chosen = chosen.when(test(value), label)
    return chosen.otherwise(last)


def geo_bins(
    df: DataFrame, lat: str, lon: str, digits: int, names: tuple[str, str], aggs: dict[str, Column]
) -> DataFrame:
    """Aggregates per grid cell of ``digits`` decimals; points without a coordinate are left out."""
    cells = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).withColumns({
        names[0]: round_to_grid(F.col(lat), digits),
        names[1]: round_to_grid(F.col(lon), digits),
    })
    return summary_by(cells, list(names), aggs)


def keyword_score(
    df: DataFrame, key: str, item: str, text: str, weights: Sequence[tuple[Sequence[str], int]], names: tuple[str, str]
) -> DataFrame:
    """Distinct items and summed keyword weight per key; a text takes the weight of the first rule it matches."""
    (words, points), *more = weights
    lower = F.lower(text)
    weight = F.when(contains_any(lower, words), points)
    for words, points in more:
        weight = weight.when(contains_any(lower, words), points)
    return df.groupBy(key).agg(
        F.count_distinct(item).alias(names[0]),
        F.sum(weight.otherwise(0)).alias(names[1]),
    )


def left_join_count(
    base: DataFrame, child: DataFrame, key: str, child_item: str, dims: list[str], maxima: list[str], out: str
) -> DataFrame:
    """Children per base group (0 where there are none) with the maxima of base columns.

    Both sides are reduced before they meet, so the join sees one row per key on the right and one per group
    on the left, however many rows or copies a key has.
    """
    groups = base.groupBy(*dims).agg(F.count(F.lit(1)).alias("__copies"), *[F.max(c).alias(c) for c in maxima])
    children = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(child_item).alias("__children"))
    joined = groups.join(children, key, "left")
    counted = F.coalesce(F.col("__children") * F.col("__copies"), F.lit(0).cast("bigint"))
    return joined.select(*dims, counted.alias(out), *maxima)


def std_by_key(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """(key, sample standard deviation) of every key."""
    return summary_by(df.where(F.col(key).isNotNull()), [key], {out: F.stddev_samp(value)})


def with_group_std(
    df: DataFrame, stats: DataFrame, key: str, out: str, spread_by: list[str], hot_rows: int | None = None
) -> DataFrame:
    """Add the deviation of a row's group; 0 for a single value or a missing key."""
    joined = lookup_join(df, stats.select(key, out), key, spread_by, hot_rows=hot_rows)
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(0.0)))


def group_std(
    df: DataFrame, key: str, value: str, out: str, spread_by: list[str], hot_rows: int | None = None
) -> DataFrame:
    """Sample standard deviation of the row's group on every row.

    An aggregate joined back instead of a window: a window would gather a whole group in one task.
    """
    return with_group_std(df, std_by_key(df, key, value, out), key, out, spread_by, hot_rows)


def top_by(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of an order; each task keeps only its own best ``n``."""
    return df.orderBy(*order).limit(n)
