"""Tables in hash buckets whose buckets are replaced one by one (copy on write).

``<folder>/buckets_<n>/table_version=<v>/table_bucket=<b>`` holds bucket ``b`` as written by version ``v``, in one file.  The newest version of a bucket
counts.  As a bucket appears by one rename, a write that broke off leaves every bucket either old or new, and the same step run again completes it.
Older versions stay until the next write, for readers that began before.  Every bucket holds one filler row, so a bucket that has become empty still
replaces its older version; readers leave it out.  One writer at a time is assumed.

What reaches the driver is one number per bucket.  Choose the number of buckets so that one is about a file's size; it stays as begun.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homelake.operators.dedupe import newest_stored, rows_at, with_position, without_position
from homelake.session import cut_lineage
from homelake.sources.keys import list_files

BUCKETS = 64
BUCKET, VERSION = "table_bucket", "table_version"
_FILLER, _PLACE = "__filler", "__place"


def _location(spark: SparkSession, folder: str, buckets: int | None = None) -> tuple[str, int]:
    """(folder of the versions, number of buckets); the number a table was begun with stays."""
    begun = list_files(spark, f"{folder.rstrip('/')}/buckets_*")
    buckets = int(begun[0].rsplit("_", 1)[-1]) if begun else buckets or BUCKETS
    return f"{folder.rstrip('/')}/buckets_{buckets}", buckets


def is_bucketed(spark: SparkSession, folder: str) -> bool:
    return bool(list_files(spark, f"{folder.rstrip('/')}/buckets_*/{VERSION}=*"))


def remove_buckets(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the table, or all of it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bucket_number(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def bucket_versions(spark: SparkSession, folder: str) -> dict[int, int]:
    """Newest version of every bucket that was written."""
    newest: dict[int, int] = {}
    for path in list_files(spark, f"{_location(spark, folder)[0]}/{VERSION}=*/{BUCKET}=*"):
        version, bucket = map(int, re.search(rf"{VERSION}=(\d+)/{BUCKET}=(\d+)$", path).groups())
        newest[bucket] = max(version, newest.get(bucket, version))
    return newest


def read_buckets(spark: SparkSession, folder: str, only: list[int] | None = None) -> DataFrame:
    """Rows of the table, or of some of its buckets, with their bucket and its version."""
    return _bucket_files(spark, folder, only).where(~F.col(_FILLER)).drop(_FILLER)


def _bucket_files(spark: SparkSession, folder: str, only: list[int] | None = None) -> DataFrame:
    location, versions = _location(spark, folder)[0], bucket_versions(spark, folder)
    paths = [f"{location}/{VERSION}={versions[b]}/{BUCKET}={b}" for b in (sorted(versions) if only is None else only)]
    return spark.read.option("basePath", location).parquet(*paths)


def replace_buckets(
    rows: DataFrame, folder: str, versions: dict[int, int], buckets: int | None = None,
    finish: Callable[[DataFrame, list[str]], DataFrame] | None = None, kept: DataFrame | None = None,
) -> None:
    """Write whole buckets under the given version numbers: the rows whose ``BUCKET`` is among them, and nothing else, is what they hold from now on.

    ``finish`` turns rows into what is stored and keeps the named columns; it comes after the join with the buckets, as a join above long expressions makes
    Spark's constraint inference take minutes.  ``kept`` are further rows, which are finished.
    """
    if not versions:
        return
    spark = rows.sparkSession
    location, _ = _location(spark, folder, buckets)
    _remove_older(spark, folder)
    listed = [(bucket, version, place) for place, (bucket, version) in enumerate(sorted(versions.items()))]
    wanted = spark.createDataFrame(listed, f"{BUCKET} int, {VERSION} int, {_PLACE} int")
    place = F.broadcast(wanted.drop(VERSION))
    placed = rows.drop(VERSION).join(place, BUCKET).drop(BUCKET)
    placed = finish(placed, [_PLACE]) if finish else placed
    if kept is not None:
        placed = placed.unionByName(kept.drop(VERSION).join(place, BUCKET).drop(BUCKET))
    full = placed.withColumn(_FILLER, F.lit(False)).unionByName(wanted.select(_PLACE, F.lit(True).alias(_FILLER)), allowMissingColumns=True)
    # One task writes a bucket, in one file; files are put in place by their task's number, as a partitioned write would sort whole buckets first.
    staged = f"{folder.rstrip('/')}/staged-{uuid4().hex}"
    one_each = full.repartitionById(len(listed), _PLACE).drop(_PLACE)
    one_each.write.options(maxRecordsPerFile=0, compression="zstd").parquet(staged)
    _put_in_place(spark, staged, location, listed)


def _put_in_place(spark: SparkSession, staged: str, location: str, listed: list[tuple[int, int, int]]) -> None:
    """Make the file of each task the bucket it was written for, by one rename of its folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    files = {int(re.search(r"/part-(\d+)-[^/]*$", file)[1]): file for file in list_files(spark, f"{staged}/part-*")}
    for bucket, version, place in listed:
        own, target = f"{staged}/bucket_{bucket}", f"{location}/{VERSION}={version}/{BUCKET}={bucket}"
        system.mkdirs(path(own))
        system.mkdirs(path(f"{location}/{VERSION}={version}"))
        remove_buckets(spark, target)
        if not (system.rename(path(files[place]), path(f"{own}/{files[place].rsplit('/', 1)[-1]}")) and system.rename(path(own), path(target))):
            raise OSError(f"could not move {files[place]} to {target}")
    remove_buckets(spark, staged)


def _remove_older(spark: SparkSession, folder: str) -> None:
    location, versions = _location(spark, folder)[0], bucket_versions(spark, folder)
    for path in list_files(spark, f"{location}/{VERSION}=*/{BUCKET}=*"):
        version, bucket = map(int, re.search(r"=(\d+)/.*=(\d+)$", path).groups())
        if version < versions[bucket]:
            remove_buckets(spark, path)


def upsert_latest(
    rows: DataFrame, folder: str, keys: list[str], newest_first: list[str], buckets: int | None = None,
    finish: Callable[[DataFrame, list[str]], DataFrame] | None = None,
) -> list[int]:
    """Bring the newest version of each key into a table of one row per key, and return the buckets that were rewritten.

    A row replaces the stored one of its key if its ``newest_first`` values are higher (missing ones are lowest), as in :func:`latest_per_key`; equal or
    older rows change nothing, so runs may come in any order or again.  Only key and order columns are read to find what is new, and only
    buckets that get a new version are read whole and rewritten.  ``finish`` turns chosen rows into what the table holds and leaves key and order columns
    as they are.

    Rows are stored once as they come; what is new and what it replaces is found on key and order columns, and whole rows are shuffled once, to their bucket.
    """
    spark = rows.sparkSession
    _, buckets = _location(spark, folder, buckets)
    held = bucket_versions(spark, folder)
    number = bucket_number(keys, buckets)
    wide, newest = newest_stored(rows, keys, newest_first)
    fresh = cut_lineage(newest.withColumn(BUCKET, number))
    touched = _buckets_of(fresh)
    met = [bucket for bucket in touched if bucket in held]
    if met:
        stamps = read_buckets(spark, folder, met).select(*[F.col(c).alias(f"__of_{c}") for c in [*keys, *newest_first]], F.lit(True).alias("__stored"))
        order, stored_order = F.struct(*newest_first), F.struct(*[f"__of_{c}" for c in newest_first])
        fresh = rows_at(fresh, fresh.join(stamps, _same(keys), "left").where(F.col("__stored").isNull() | (order > stored_order)))
        touched = _buckets_of(fresh)
    left = None
    kept = [bucket for bucket in touched if bucket in held]
    if kept:
        replaced = fresh.select(*[F.col(c).alias(f"__of_{c}") for c in keys])
        # A bucket is one file, so its number and a row's place in the file are a position.
        place = F.shiftleft(F.col(BUCKET).cast("bigint"), 40) + F.col("_metadata.row_index")
        stored = with_position(_bucket_files(spark, folder, kept), place).where(~F.col(_FILLER)).drop(VERSION, _FILLER)
        left = without_position(rows_at(stored, stored.join(replaced, _same(keys), "left_semi"), keep=False))
    version = max(held.values(), default=0) + 1
    chosen = without_position(rows_at(wide, fresh)).withColumn(BUCKET, number)
    replace_buckets(chosen, folder, {bucket: version for bucket in touched}, buckets, finish, left)
    return touched


def _buckets_of(rows: DataFrame) -> list[int]:
    return sorted(row[0] for row in rows.select(BUCKET).distinct().collect())


def _same(keys: list[str]) -> Column:
    """Equal keys, a missing one equal to a missing one."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in keys])
