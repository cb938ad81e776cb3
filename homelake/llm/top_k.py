"""Exact top-k inner products over vectors in buckets of similar length.

Vectors are laid out by length, longest first, as a range-partitioned table, and read in buckets of ``BUCKET_ROWS``.  For a query, the k-th best product
found so far is a bound: a bucket whose longest vector cannot reach it is skipped, and where that holds for all queries so is what follows.  Within a
bucket the bound becomes a cosine threshold.  Where that threshold is high, coordinates prune: a vector whose
cosine reaches it must lie in a narrow interval in the query's largest coordinates.  Where it is low, length prunes: only vectors long
enough stay.  What is left is verified by exact integer products, so no pair is lost.

Queries are a stated set; they go to the executors in blocks of at most ``QUERY_BLOCK`` (2 MB at 64 dimensions) and meet all vectors where these
lie.  A sample of about ``SEED_ROWS`` vectors by the hash of their row number gives every query a first bound, so a task
returns few rows; at most k rows per query and task meet in the last ranking.

Products are computed in 64 bits where dimension x largest component x largest component stays below 2**63, else, for those rows alone, in
Python's unbounded integers.

Defined results: vectors that are null, empty, or hold a null or non-finite component take no part, nor do rows without id; of several rows of one id each is a
query of its own and a candidate for the others; repeated rows are candidates each; vectors of another dimension than the query are no
candidates; components and scores beyond 64 bits become the nearest 64-bit integer, and scores are ranked as such.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homelake.llm.common import drawn, table
from homelake.session import cut_lineage

QUERY_BLOCK = 4_096
SEED_ROWS = 4_096
BUCKET_ROWS = 2_048
FOCUS = 4
# Above this cosine threshold coordinates prune better than length alone.
COORDINATE_COSINE = 0.3
SCALE = 1024


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Stored (row, vec_id, norm, v): floor(1024 * x) of every component as whole numbers, longest vectors first."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    most = F.lit(9.2e18)
    whole = F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, most), -most)).cast("long"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda sum_, x: sum_ + x.cast("double") * x.cast("double")))
    rows = vectors.where(F.col(key).isNotNull() & (F.size(vector) > 0) & usable).select(F.col(key).cast("long").alias("vec_id"), whole.alias("v"))
    order = [F.desc("norm"), F.col("vec_id")]
    laid_out = rows.withColumn("norm", norm).repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(laid_out.select(F.monotonically_increasing_id().alias("row"), "vec_id", "norm", "v"))


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(row, dtype=np.int64) for row in rows])


def _products(rows: np.ndarray, peaks: np.ndarray, vector: np.ndarray, peak: int) -> np.ndarray:
    """Exact products of rows whose largest components are ``peaks`` with a vector whose is ``peak``; beyond 64 bits the nearest such integer."""
    wide = peaks * float(peak) * rows.shape[1] >= 2.0**62
    if not wide.any():
        return rows @ vector
    out = np.zeros(len(rows), dtype=np.int64)
    out[~wide] = rows[~wide] @ vector
    ends = np.iinfo(np.int64)
    out[wide] = [min(max(int(score), ends.min), ends.max) for score in rows[wide].astype(object) @ vector.astype(object)]
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        bound = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= bound)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


class _Bucket:
    """Vectors of similar length, longest first."""

    def __init__(self, numbers: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        lengths = np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))
        order = np.argsort(-lengths, kind="stable")
        self.numbers, self.ids, self.rows, self.lengths = numbers[order], ids[order], rows[order], lengths[order]
        self.peaks = np.abs(self.rows.astype(np.float64)).max(axis=1)
        self.units = (self.rows / np.maximum(self.lengths, 1e-300)[:, None]).T.copy()

    def survivors(self, unit: np.ndarray, length: float, bound: int | None) -> np.ndarray:
        """Places of all vectors that may reach ``bound`` with a query of this direction and length."""
        if bound is None or bound <= 0 or not length:
            return np.arange(len(self.ids))
        longest = self.lengths[0]
        cosine = bound / (length * longest) if longest else 2.0
        if cosine > 1 + 1e-9:
            return np.array([], dtype=np.int64)
        # By length: shorter vectors cannot reach the bound even in the query's own direction.
        enough = int(np.searchsorted(-self.lengths, -(bound / length) * (1 - 1e-9), side="right"))
        if cosine < COORDINATE_COSINE:
            return np.arange(enough)
        # By coordinates: cosine(p, q) >= c bounds each coordinate of p around c times that of q.
        places = np.arange(enough)
        cosine = min(1.0, cosine)
        for axis in np.argsort(-np.abs(unit))[:FOCUS]:
            reach = np.sqrt(max(0.0, 1 - unit[axis] ** 2) * (1 - cosine**2)) + 1e-6
            low = unit[axis] * cosine - reach if unit[axis] * cosine - reach > -1 and -unit[axis] < cosine else -1.0
            high = unit[axis] * cosine + reach if unit[axis] < cosine else 1.0
            own = self.units[axis, places]
            places = places[(own >= low) & (own <= high)]
        return places


# Per query: its best scores so far, their ids, best first.
Best = dict[int, tuple[np.ndarray, np.ndarray]]


class _Query(NamedTuple):
    row: int
    query_id: int
    vector: np.ndarray
    length: float
    peak: int
    bound: int | None


def _query(row: int, query_id: int, vector: np.ndarray, bound: int | None = None) -> _Query:
    length = float(np.sqrt((vector.astype(np.float64) ** 2).sum()))
    return _Query(int(row), int(query_id), vector, length, max(abs(int(x)) for x in vector), bound)


def _search(queries: list[_Query], numbers: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, best: Best, bounds: dict[int, int]) -> None:
    """Put a bucket's vectors into ``best``: each query's k highest scores so far (from its bound on) and their ids; ``bounds`` rise."""
    bucket, nothing = _Bucket(numbers, ids, rows), np.array([], dtype=np.int64)
    for query in queries:
        if len(query.vector) != rows.shape[1]:
            continue
        bound = bounds.get(query.row, query.bound)
        unit = query.vector / query.length if query.length else query.vector.astype(np.float64)
        places = bucket.survivors(unit, query.length, bound)
        places = places[bucket.numbers[places] != query.row]
        products = _products(bucket.rows[places], bucket.peaks[places], query.vector, query.peak)
        good = products >= bound if bound is not None else np.ones(len(places), dtype=bool)
        if not good.any():
            continue
        scores, own = best.get(query.row, (nothing, nothing))
        scores, own = np.concatenate([scores, products[good]]), np.concatenate([own, bucket.ids[places][good]])
        kept = _best(scores, own, k)
        best[query.row] = scores[kept], own[kept]
        if len(kept) == k:
            bounds[query.row] = max(int(scores[kept[-1]]), bound if bound is not None else int(scores[kept[-1]]))


def _searched(batches: Iterator[pd.DataFrame], queries: list[_Query], k: int) -> Best:
    best: Best = {}  # at most k rows per query of the block, whatever the number of vectors
    bounds: dict[int, int] = {}
    for batch in batches:
        for _, part in batch.sort_values("norm", ascending=False, kind="stable").groupby(batch["v"].map(len)):
            for at in range(0, len(part), BUCKET_ROWS):
                run = part.iloc[at : at + BUCKET_ROWS]
                longest = float(run["norm"].iloc[0]) * (1 + 1e-9)
                alive = [q for q in queries if (bounds.get(q.row, q.bound) or 0) <= q.length * longest]
                if not alive:
                    break  # what follows is shorter still
                _search(alive, run["row"].to_numpy(), run["vec_id"].to_numpy(), _matrix(run["v"]), k, best, bounds)
    return best


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: for each of ``queries``, which are rows of the stored ``vectors``, its k best of the others."""
    spark = vectors.sparkSession
    blocks = max(1, ceil(queries.count() / QUERY_BLOCK))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    seeds = vectors.where(drawn(F.col("row"), SEED_ROWS, vectors.count())).toPandas()
    schema = "query_row long, query_id long, vec_id long, score long"
    every = spark.createDataFrame([], schema)
    for block in range(blocks):
        own = queries.where(F.col("block") == block).select("row", "vec_id", "v").toPandas()
        plain = [_query(row, query_id, np.asarray(v, dtype=np.int64)) for row, query_id, v in zip(own["row"], own["vec_id"], own["v"])]
        shared = spark.sparkContext.broadcast(_seeded(plain, seeds, k))

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            found, names = _searched(batches, shared.value, k), {q.row: q.query_id for q in shared.value}
            if found:
                scores, ids = (np.concatenate(column) for column in zip(*found.values()))
                rows = np.repeat(list(found), [len(own) for own, _ in found.values()])
                yield pd.DataFrame({"query_row": rows, "query_id": [names[row] for row in rows.tolist()], "vec_id": ids, "score": scores})

        every = every.union(vectors.mapInPandas(search, schema))
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _seeded(queries: list[_Query], seeds: pd.DataFrame, k: int) -> list[_Query]:
    """Queries with their k-th best product over the sample as a first bound."""
    best = _searched(iter([seeds] if len(seeds) else []), queries, k)
    return [q._replace(bound=int(best[q.row][0][-1])) if q.row in best and len(best[q.row][0]) >= k else q for q in queries]


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


ORACLE = """
WITH whole AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.rid, q.vec_id AS query_id, p.vec_id, CAST(list_sum(list_transform(list_zip(q.v, p.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM whole AS q JOIN whole AS p ON q.vec_id % 100 = 0 AND p.rid <> q.rid),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
