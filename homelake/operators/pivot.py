"""Long monthly series to a wide table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SERIES = "__series"


def series_name(prefix: str, year: Column, month: Column) -> Column:
    """Column name of a month, such as ``price_2024_03``; null when a part is missing."""
    return F.concat(F.lit(prefix), year.cast("string"), F.lit("_"), F.lpad(month.cast("string"), 2, "0"))


def with_series_key(df: DataFrame, year: str, month: str, prefix: str = "price_") -> DataFrame:
    """Add the month key and drop rows without one, so that no column is named after a null."""
    return df.withColumn(SERIES, series_name(prefix, F.col(year), F.col(month))).where(F.col(SERIES).isNotNull())


def series_keys(df: DataFrame, year: str, month: str, prefix: str = "price_") -> list[str]:
    """The month keys present, in order.  More than the session's ``spark.sql.pivotMaxValues`` are refused, as Spark's own pivot does."""
    keys = with_series_key(df, year, month, prefix).select(SERIES).distinct()
    found = keys.agg(F.count("*").alias("n"), F.array_sort(F.collect_list(SERIES)).alias("keys")).first()
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    if found["n"] > most:
        raise ValueError(f"{found['n']} distinct months, spark.sql.pivotMaxValues is {most}; check the year and month columns")
    return list(found["keys"])


def pivot_series(
    df: DataFrame,
    key: str,
    year: str,
    month: str,
    value: str,
    order_col: str | None = None,
    months: list[str] | None = None,
    prefix: str = "price_",
) -> DataFrame:
    """One row per key with one column per month.

    Of repeated months the row with the highest ``order_col`` is kept, or the highest value where no order is given.
    """
    months = series_keys(df, year, month, prefix) if months is None else months
    picked = F.max_by(value, order_col) if order_col else F.max(value)
    keyed = with_series_key(df, year, month, prefix)
    # One row per key and month first: it makes the second step small whatever the order column's type.
    monthly = keyed.groupBy(key, SERIES).agg(picked.alias(value))
    return monthly.groupBy(key).pivot(SERIES, months).agg(F.first(value))
