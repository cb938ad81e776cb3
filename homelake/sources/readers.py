"""Readers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_ID = "__run_id"


def run_glob(bronze_dir: str, entity: str) -> str:
    """All runs of an entity: plain ``<entity>*.jsonl`` files and the directories ``append_run`` writes."""
    return f"{bronze_dir.rstrip('/')}/{entity}*.jsonl"


def read_entity(spark: SparkSession, path_glob: str, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """JSON lines of all runs under one schema, without an inference pass.

    ``FAILFAST`` stops at a malformed line; ``DROPMALFORMED`` skips it.
    """
    return spark.read.schema(schema).option("mode", mode).json(path_glob)


def with_run_id(df: DataFrame, entity: str) -> DataFrame:
    """Add the run stamp taken from the file or directory name, the tiebreak between copies of a record."""
    stamp = F.regexp_extract(F.col("_metadata.file_path"), rf"{entity}_?([^/]*)\.jsonl", 1)
    return df.withColumn(RUN_ID, stamp)


def history_ids(spark: SparkSession, path_glob: str, key: str) -> DataFrame:
    """Distinct keys of all earlier runs; malformed lines and rows without the key are skipped.

    A folder without earlier runs gives no keys.
    """
    schema = T.StructType([T.StructField(key, T.StringType())])
    try:
        rows = read_entity(spark, path_glob, schema, mode="DROPMALFORMED")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return distinct_keys(rows, key)


def distinct_keys(rows: DataFrame, key: str) -> DataFrame:
    return rows.where(F.col(key).isNotNull()).select(key).distinct()


def read_table(spark: SparkSession, name: str, catalog: str | None = None, schema: str | None = None) -> DataFrame:
    """Catalog table, looked up in the given catalog and schema where named."""
    return spark.read.table(".".join(part for part in (catalog, schema, name) if part))


def read_tables(spark: SparkSession, directory: str, names: list[str]) -> dict[str, DataFrame]:
    """Parquet tables of a layer, one folder each."""
    return {name: spark.read.parquet(f"{directory.rstrip('/')}/{name}") for name in names}


def load_fixture(spark: SparkSession, path: str) -> DataFrame:
    """Small test input: a JSON array of records, or CSV with a header where every column is text."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "json":
        return spark.read.option("multiLine", True).json(path)
    if suffix == "csv":
        return spark.read.option("header", True).csv(path)
    raise ValueError(f"unsupported fixture type: {path}")
