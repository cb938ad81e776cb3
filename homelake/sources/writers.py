"""Writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_table(df: DataFrame, directory: str, name: str) -> None:
    """Replace one Parquet table of a layer."""
    df.write.mode("overwrite").parquet(f"{directory.rstrip('/')}/{name}")


def append_run(records: DataFrame, bronze_dir: str, entity: str, run_id: str) -> int:
    """Write a run's records as JSON lines next to the earlier runs, and return how many were written.

    ``records`` holds typed columns, or ready-made JSON objects in a single column named ``record``.  A run
    never replaces an earlier one; a run without records leaves an empty folder.  The rows are counted while
    they are written, so the records are computed once.
    """
    counted = Observation(f"{entity}_{run_id}")
    rows = records.observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode("errorifexists")
    path = f"{bronze_dir.rstrip('/')}/{entity}_{run_id}.jsonl"
    if records.columns == ["record"]:
        writer.text(path)
    else:
        writer.json(path)
    return counted.get.get("rows", 0)


def spread_order(df: DataFrame, *columns: Column) -> DataFrame:
    """Total order for a sorted export.

    The last sort key splits runs of equal rows over range partitions; a range boundary cannot fall inside them.
    """
    return df.orderBy(*columns, F.rand(seed=11))
