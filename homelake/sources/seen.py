"""Ids of all earlier runs, kept as a key table so that a run need not read the records of the earlier ones.

``<bronze>/seen_ids/<entity>`` holds the table (see :mod:`homelake.sources.keys`) and, in ``runs``, an empty file per run whose ids are all in it.  The
run files stay the truth: a run without that file, because it is older than the table or broke off before its ids were written, is read and added.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from homelake.sources.keys import add_keys, list_files, stored_keys
from homelake.sources.readers import read_entity, run_glob


def _folder(bronze_dir: str, entity: str) -> str:
    return f"{bronze_dir.rstrip('/')}/seen_ids/{entity}"


def add_seen(rows: DataFrame, bronze_dir: str, entity: str, key: str, run_id: str) -> None:
    """Note the ids of a run after its records are written; noting a run twice changes nothing."""
    spark, folder = rows.sparkSession, _folder(bronze_dir, entity)
    add_keys(rows, folder, key)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/runs/run_{run_id}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True).close()


def seen_ids(spark: SparkSession, bronze_dir: str, entity: str, key: str) -> DataFrame:
    """Distinct ids of all earlier runs; malformed lines and records without the id are skipped."""
    folder = _folder(bronze_dir, entity)
    stamp = re.compile(rf"{re.escape(entity)}_?([^/]*)\.jsonl$")
    runs = {stamp.search(path)[1]: path for path in list_files(spark, run_glob(bronze_dir, entity))}
    noted = {path.rsplit("/run_", 1)[-1] for path in list_files(spark, f"{folder}/runs/run_*")}
    schema = T.StructType([T.StructField(key, T.StringType())])
    for run_id in sorted(set(runs) - noted):
        add_seen(read_entity(spark, runs[run_id], schema, mode="DROPMALFORMED"), bronze_dir, entity, key, run_id)
    return stored_keys(spark, folder, key).distinct()  # within buckets, without a shuffle
