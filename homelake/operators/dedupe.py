"""One row per key, first occurrences, unseen rows and the prefix of pages that still bring new ones.

Every "one row per key" below filters a row number to 1 in the same query, which Spark turns into a
``WindowGroupLimit`` before the exchange: each task sends at most one row per key, so a key that
holds a large share of all rows does not load one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homelake.session import cut_lineage

_RANK, _BRINGS = "__rank", "__brings"
_AT, _CHUNK = "__at", "__chunk"
# A chunk of stored rows is marked in so many words of 64 bits; above so many rows their marks are not broadcast (a bit a row, 170 MB).
WORDS = 16
MARKED_ROWS = 1 << 30
# Wide rows are stored small, and in row groups of which Spark can deal those of one large file to many tasks.
WIDE_ROWS = {"compression": "zstd", "parquet.block.size": 8 << 20}


def _first_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(df: DataFrame, keys: list[str], newest_first: list[str]) -> DataFrame:
    """Row with the highest values of ``newest_first``; missing values count as oldest."""
    return _first_row(df, keys, [F.col(name).desc_nulls_last() for name in newest_first])


def latest_stored(df: DataFrame, keys: list[str], newest_first: list[str]) -> DataFrame:
    """As :func:`latest_per_key`, for wide rows: they are stored once, only key and order columns are shuffled and sorted, and the
    chosen rows are read back from where they stand, without a shuffle."""
    return rows_at(*newest_stored(df, keys, newest_first)).drop(_AT)


def newest_stored(df: DataFrame, keys: list[str], newest_first: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows, stored with their positions, and position, key and order columns of the newest row per key."""
    stored = cut_lineage(with_position(df), **WIDE_ROWS)
    return stored, latest_per_key(stored.select(_AT, *dict.fromkeys([*keys, *newest_first])), keys, newest_first)


def with_position(df: DataFrame, position: Column | None = None) -> DataFrame:
    """Add the position that :func:`rows_at` reads: a whole number of its own per row, fixed because it is stored or follows from the file."""
    return df.withColumn(_AT, F.monotonically_increasing_id() if position is None else position)


def without_position(df: DataFrame) -> DataFrame:
    return df.drop(_AT)


def rows_at(stored: DataFrame, chosen: DataFrame, keep: bool = True) -> DataFrame:
    """Stored rows whose position is among those of ``chosen`` (with ``keep`` false: is not).

    The positions become a bit per stored row, stored and broadcast, so the wide rows are filtered where they are read.  Above ``MARKED_ROWS`` rows
    both sides are shuffled by position instead.
    """
    positions = chosen.select(_AT)
    if stored.count() > MARKED_ROWS:
        return stored.join(positions, _AT, "left_semi" if keep else "left_anti")
    bit, word = F.col(_AT).bitwiseAND(F.lit(63)).cast("int"), F.shiftright(_AT, 6).bitwiseAND(F.lit(WORDS - 1)).cast("int")
    chunk = F.shiftright(_AT, 6 + WORDS.bit_length() - 1).alias(_CHUNK)
    mark = F.expr(f"shiftleft(1L, CAST({_AT} & 63 AS INT))")
    marks = [F.coalesce(F.bit_or(F.when(word == i, mark)), F.lit(0).cast("bigint")).alias(f"__word_{i}") for i in range(WORDS)]
    chunks = cut_lineage(positions.groupBy(chunk).agg(*marks))
    marked = F.getbit(F.get(F.array(*[f"__word_{i}" for i in range(WORDS)]), word), bit) == 1
    found = stored.withColumn(_CHUNK, chunk).join(F.broadcast(chunks), _CHUNK, "inner" if keep else "left")
    return found.where(marked if keep else F.coalesce(~marked, F.lit(True))).select(*stored.columns)


def one_per_key(df: DataFrame, keys: list[str], tiebreak: list[str] | None = None) -> DataFrame:
    """Any row per key, but the same one in every run: lowest ``tiebreak`` values, or lowest row hash."""
    order = [F.col(name).asc_nulls_last() for name in tiebreak] if tiebreak else [F.xxhash64(*df.columns)]
    return _first_row(df, keys, order)


def first_in_batch(batch: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """First occurrence of each key in reading order."""
    return _first_row(batch, [key], [F.col(name).asc() for name in order_cols])


def new_rows(
    batch: DataFrame, history: DataFrame, key: str, order_cols: list[str], long_history: bool = False
) -> DataFrame:
    """First occurrences whose key the history does not hold; rows without a key are no occurrences.

    The batch is reduced to one row per key before the join.  With ``long_history`` the history is first
    cut to the keys of the batch, so a history far larger than the batch is filtered where it is read.
    """
    keyed = batch.where(F.col(key).isNotNull())
    fresh = first_in_batch(keyed, key, order_cols)
    known = history.select(key)
    if long_history:
        known = known.join(keyed.select(key).distinct(), key, "left_semi")
    return fresh.join(known.distinct(), key, "left_anti")


def prefix_until_stale(
    batch: DataFrame,
    history: DataFrame,
    page: str,
    pos_cols: list[str],
    key: str,
    first_page: int = 1,
    unread: DataFrame | None = None,
    long_history: bool = False,
) -> DataFrame:
    """New rows of the pages before the first one that brings none.

    A page brings none when all its keys were seen on earlier pages or in the history, when it has no rows
    or when it is missing.  A page of ``unread`` (a table with the page column) could not be read and does not end the crawl.  That page is the smallest number from ``first_page`` on that is not among the pages with
    new rows: the first page itself or the successor of one of them.
    """
    # Stored: the stopping page and the result both need it, and the comparison with the history is made once.
    fresh = cut_lineage(new_rows(batch, history, key, [page, *pos_cols], long_history))
    number = batch.schema[page].dataType
    start = batch.sparkSession.range(1).select(F.lit(first_page).cast(number).alias(page), F.lit(False).alias(_BRINGS))
    here = F.struct(F.col(page).alias(page), F.lit(True).alias(_BRINGS))
    following = F.struct((F.col(page) + 1).cast(number).alias(page), F.lit(False).alias(_BRINGS))
    bringing = fresh.select(page) if unread is None else fresh.select(page).union(unread.select(page))
    candidates = (
        bringing.where(F.col(page) >= first_page).select(F.inline(F.array(here, following))).unionByName(start)
    )
    stale = candidates.groupBy(page).agg(F.bool_or(_BRINGS).alias(_BRINGS)).where(~F.col(_BRINGS))
    return fresh.where(F.col(page).between(F.lit(first_page), stale.agg(F.min(page)).scalar() - 1))
