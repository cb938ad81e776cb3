"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homelake.session import cut_lineage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """Fold that no model may learn labels from; a missing id belongs to the training folds."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def drawn(key: Column, wanted: int, rows: int) -> Column:
    """Whether a row belongs to a sample of about ``wanted`` of ``rows`` rows, by the hash of its key; the share is as fine as 63 bits."""
    share = min(1.0, wanted / max(1, rows))
    return F.shiftrightunsigned(F.xxhash64(key, F.lit("drawn")), 1) <= min(int(share * 2.0**63), 2**63 - 1)


def placed(df: DataFrame, group: str, order: list[str], number: str = "number", place: str = "place", size: str = "rows") -> DataFrame:
    """Stored rows of ``df`` with the rank of their group by its value (nulls first), their place in it by ``order`` (both from 0) and its rows.

    Rows are laid out by range; ranges are counted, then each is numbered for itself, so no task holds a group.
    """
    ranged = cut_lineage(df.repartitionByRange(F.col(group).asc_nulls_first(), *[F.col(name).asc_nulls_first() for name in order])
                         .withColumn("__range", F.spark_partition_id()))
    counts = cut_lineage(ranged.groupBy(F.col(group).alias("__group"), F.col("__range").alias("__part")).agg(F.count("*").alias("__n")))
    before = Window.partitionBy("__group").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.withColumns({
        "__ahead": F.coalesce(F.sum("__n").over(before), F.lit(0)), size: F.sum("__n").over(Window.partitionBy("__group")),
        "__first": F.min("__part").over(Window.partitionBy("__group"))})
    # A group is numbered in the range it begins in, after the groups that begin in earlier ranges.
    begun = ahead.where("__part = __first").select("__group", "__first")
    begins = begun.groupBy("__first").agg(F.count("*").alias("__begin"))
    earlier = Window.orderBy("__first").rowsBetween(Window.unboundedPreceding, -1)  # at most one row per partition of the layout
    offsets = begins.select(F.col("__first").alias("__at"), F.coalesce(F.sum("__begin").over(earlier), F.lit(0)).alias("__offset"))
    rank = F.row_number().over(Window.partitionBy("__first").orderBy(F.col("__group").asc_nulls_first())) - 1
    numbers = begun.withColumn("__rank", rank).join(offsets, F.col("__first") == F.col("__at")).select(
        F.col("__group").alias("__own"), (F.col("__offset") + F.col("__rank")).cast("long").alias(number))
    known = cut_lineage(ahead.join(numbers, F.col("__group").eqNullSafe(F.col("__own"))).select("__group", "__part", "__ahead", size, number))
    within = Window.partitionBy(group, "__range").orderBy(*[F.col(name).asc_nulls_first() for name in order])
    counted = ranged.withColumn("__within", F.row_number().over(within) - 1)
    return counted.join(known, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__range") == F.col("__part"))).withColumn(
        place, (F.col("__ahead") + F.col("__within")).cast("long")).drop("__range", "__within", "__group", "__part", "__ahead")
