"""Key tables: the keys handled so far, hash-bucketed and sorted, next to the data they come from.

``<folder>/hashed_<n>`` is a Parquet table of one column in n hash buckets, each file sorted by key and with a Bloom filter per row group.  A join on
the key reads it bucket by bucket, so the history is not shuffled (as long as it has at least as many buckets as the session's shuffles start with
partitions, else Spark prefers to shuffle both sides; a new table takes that number, ``BUCKETS`` at least); a filter on a list of keys reads only their buckets, and of those
only row groups whose range and Bloom filter may hold one.

Keys are added as one file per bucket.  A key may stand there twice (a step was repeated after a failure), which changes no comparison.  Buckets of many files
are rewritten one by one: the merged file is in place before the old ones go, so a broken-off compaction leaves repeated keys, never a gap.
One writer at a time is assumed, as for the tables themselves.
"""

from __future__ import annotations

import re
from collections import defaultdict
from hashlib import sha256
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
# A bucket with more files is merged.
MOST_FILES = 16
# So many keys of a batch go into the filter of the scan; beyond that the batch meets the buckets by a join.
PUSHED_KEYS = 1_000
_BUCKET_FILE = re.compile(r"_(\d+)(?:\..*)?$")


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(status.getPath().toString()) for status in found or [])


def _declared(spark: SparkSession, location: str, key: str, buckets: int) -> str:
    """Name of the bucketed table over a folder in this session's catalog; files that others added since are seen."""
    name = f"keys_{sha256(location.encode()).hexdigest()[:20]}"
    options = {
        f"parquet.bloom.filter.enabled#{key}": "true", f"parquet.bloom.filter.adaptive.enabled#{key}": "true",
        "parquet.block.size": str(16 << 20),  # small row groups: a key is ruled out for 16 MB at a time
    }
    listed = ", ".join(f"'{option}' = '{value}'" for option, value in options.items())
    quoted = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (`{key}` STRING) USING parquet OPTIONS ({listed}) "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{quoted}'")
    spark.catalog.refreshTable(name)
    return name


def _shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions this session's shuffles start with."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


def _opened(spark: SparkSession, folder: str, key: str, buckets: int | None = None) -> tuple[str, str, int]:
    """(table name, its folder, number of buckets); the number a table was begun with stays."""
    begun = [found for path in list_files(spark, f"{folder.rstrip('/')}/hashed_*") if (found := re.fullmatch(r"hashed_(\d+)", path.rsplit("/", 1)[-1]))]
    buckets = int(begun[0][1]) if begun else buckets or max(BUCKETS, _shuffle_partitions(spark))
    location = f"{folder.rstrip('/')}/hashed_{buckets}"
    return _declared(spark, location, key, buckets), location, buckets


def stored_keys(spark: SparkSession, folder: str, key: str, buckets: int | None = None) -> DataFrame:
    """All keys of the table, repeated ones included."""
    return spark.table(_opened(spark, folder, key, buckets)[0])


def add_keys(rows: DataFrame, folder: str, key: str, buckets: int | None = None) -> None:
    """Add the distinct keys of ``rows``, and merge the files of buckets that have become many."""
    spark = rows.sparkSession
    name, _, buckets = _opened(spark, folder, key, buckets)
    keys = rows.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias(key)).distinct()
    keys.repartition(buckets, key).write.insertInto(name)
    compact_keys(spark, folder, key)


def known_keys(spark: SparkSession, folder: str, key: str, asked: DataFrame, buckets: int | None = None) -> DataFrame:
    """Distinct keys of the table that are among ``asked`` (a column of keys, read twice)."""
    stored = stored_keys(spark, folder, key, buckets)
    few = [row[0] for row in asked.select(key).distinct().limit(PUSHED_KEYS + 1).collect()]
    if len(few) <= PUSHED_KEYS:
        return stored.where(F.col(key).isin(few)).distinct()
    return stored.join(asked.select(key).distinct(), key, "left_semi").distinct()


def compact_keys(spark: SparkSession, folder: str, key: str, most_files: int | None = None) -> int:
    """Merge each bucket of more than ``most_files`` files into one file without repeated keys; returns how many buckets were merged."""
    name, location, buckets = _opened(spark, folder, key)
    files = defaultdict(list)
    for path in list_files(spark, f"{location}/part-*"):
        files[int(_BUCKET_FILE.search(path)[1])].append(path)
    crowded = {bucket: own for bucket, own in files.items() if len(own) > (MOST_FILES if most_files is None else most_files)}
    if not crowded:
        return 0
    old = [path for own in crowded.values() for path in own]
    staged = f"{folder.rstrip('/')}/merged-{uuid4().hex}"
    merged = _declared(spark, staged, key, buckets)
    spark.read.schema(spark.table(name).schema).parquet(*old).distinct().repartition(buckets, key).write.insertInto(merged)
    spark.sql(f"DROP TABLE {merged}")
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(location).getFileSystem(spark._jsc.hadoopConfiguration())
    for new in list_files(spark, f"{staged}/part-*"):
        if not system.rename(path(new), path(f"{location}/{new.rsplit('/', 1)[-1]}")):
            raise OSError(f"could not move {new} to {location}")
    for gone in old:
        system.delete(path(gone), False)
    system.delete(path(staged), True)
    spark.catalog.refreshTable(name)
    return len(crowded)
