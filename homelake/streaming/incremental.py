"""Append only unseen records as new run files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from homelake.operators import new_rows
from homelake.sources import add_keys, known_keys

BATCH = "batch_id"


def _records(target_dir: str) -> str:
    return f"{target_dir.rstrip('/')}/records"


def read_new_records(spark: SparkSession, target_dir: str, schema: T.StructType) -> DataFrame:
    """Everything appended so far, with the number of the batch that brought it."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])).parquet(_records(target_dir))


def _open_target(spark: SparkSession, target_dir: str, schema: T.StructType) -> None:
    """Make the target readable before the first batch."""
    spark.createDataFrame([], schema).withColumn(BATCH, F.lit(-1).cast("long")).write.mode("ignore").parquet(_records(target_dir))


def _append_unseen(batch: DataFrame, batch_id: int, target_dir: str, key: str, order_cols: list[str], buckets: int | None = None) -> None:
    """Records first, then their keys.  A batch that is run again after a failure keeps what its first attempt left and adds what is missing:
    its records are told by their batch number, which each file holds one of, so only its own files are read."""
    spark, seen = batch.sparkSession, f"{target_dir.rstrip('/')}/seen"
    keyed = batch.where(F.col(key).isNotNull()).persist()
    try:
        asked = keyed.select(F.col(key).cast("string").alias(key))
        own = read_new_records(spark, target_dir, batch.schema).where(F.col(BATCH) == batch_id)
        history = known_keys(spark, seen, key, asked, buckets).select(F.col(key).cast(batch.schema[key].dataType).alias(key))
        fresh = new_rows(keyed, history.unionByName(own.select(key)), key, order_cols)
        fresh.withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("append").parquet(_records(target_dir))
        # The target is listed anew: now it has all of this batch.
        add_keys(read_new_records(spark, target_dir, batch.schema).where(F.col(BATCH) == batch_id), seen, key, buckets)
    finally:
        keyed.unpersist()


def new_records_query(
    spark: SparkSession,
    path_glob: str,
    schema: T.StructType,
    target_dir: str,
    checkpoint_dir: str,
    key: str,
    order_cols: list[str],
    max_files: int | None = None,
    buckets: int | None = None,
) -> StreamingQuery:
    """Start a query that handles all run files not handled before and then stops.

    A target belongs to one checkpoint, whose batch numbers its rows carry.  Each batch is deduplicated, compared with the target's key
    table (of which it reads only the buckets its keys fall into) and appended; no record state is kept in memory, and the number of folders does not grow.  ``max_files``
    bounds a batch, which is cached while it is compared.
    """
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.json(path_glob)
    _open_target(spark, target_dir, schema)

    def append(batch: DataFrame, batch_id: int) -> None:
        _append_unseen(batch, batch_id, target_dir, key, order_cols, buckets)

    return (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
