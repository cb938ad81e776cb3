"""Ranked lexical search over impact vectors in buckets of similar length.

A document is a sparse vector: for each of its terms that some item holds, the whole number this term adds to a score (its impact).  An item is
the set of its terms, so a score is an inner product, and a document of vector length v cannot reach more than v times the root of
the number of an item's terms (Cauchy-Schwarz).

1. Texts are scanned once where they lie; what is stored is their number of terms and the counts of item terms.
2. Counts over the corpus give weights; vectors are laid out by length, longest first, as a range-partitioned table.
3. A sample of about ``SEED_ROWS`` vectors, by the hash of their ids, gives every item a first bound: its k-th best score there.
4. Each task reads a run of lengths in buckets of ``BUCKET_ROWS``.  A bucket whose longest vector cannot reach an item's bound is skipped for
   it, and if that holds for every item, so is what follows.  Inside, the largest impact of each coordinate in the bucket tells which terms a document must hold
   at least one of; documents found there stay if what they have and the most that is left reach the bound.  Survivors
   are scored anew from all their terms in 64-bit integers, and the bound rises.

Items are a stated set; they are brought to the executors in blocks of about ``BLOCK_TERMS`` terms (one pass over the texts each; a usual
benchmark is one block).  Tasks return at most k rows per item.

Defined results: null or empty texts have no terms and do not count; items without terms that occur, or without id, have no rows; rows of one
item id are one item; documents without id count in the statistics and are no results; repeated documents are ranked each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homelake.llm.common import drawn, table
from homelake.session import cut_lineage

BLOCK_TERMS = 500_000
SEED_ROWS = 4_096
BUCKET_ROWS = 4_096
_NO_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
# Bounds are doubles; they are widened by this share, so rounding loses no document.
_SLACK = 1 + 1e-9

# Per item: its number, and its scores and documents so far, best first.
Best = dict[int, tuple[np.ndarray, np.ndarray]]


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, terms): distinct terms of every item."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = items.where(F.col(item_id).isNotNull()).select(
        F.col(item_id).alias("item_id"), F.explode(F.split(F.regexp_replace(lower, _NO_TERM, " "), " ")).alias("term"))
    return terms.where("term <> ''").groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def _counted(docs: DataFrame, vocabulary: list[str], doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, terms, tf) of documents with terms: how many, and the numbers and counts of those in the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast({term.encode(): at for at, term in enumerate(vocabulary)})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            n, terms, tf = [], [], []
            for content in batch["text"]:
                words = content.encode("utf-8", "surrogatepass").translate(_FOLD).split()
                found = Counter(map(known.get, words))
                found.pop(None, None)
                n.append(len(words))
                terms.append(sorted(found))
                tf.append([found[at] for at in terms[-1]])
            yield pd.DataFrame({"__id": batch["__id"], "n": n, "terms": terms, "tf": tf})

    # The id goes as text: pandas has no whole numbers with gaps.
    source = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).cast("string").alias("__id"), F.col(text).alias("text"))
    out = source.mapInPandas(count, "__id string, n long, terms array<int>, tf array<int>").where("n > 0")
    return cut_lineage(out.select(F.col("__id").cast("long").alias("doc_id"), "n", "terms", "tf"))


def _weights(counted: DataFrame, vocabulary: int, total: int) -> np.ndarray:
    """Weight of every vocabulary term; 0 where no document holds it."""
    df = dict(counted.select(F.explode("terms").alias("at")).groupBy("at").agg(F.count("*").alias("df")).collect())
    held = np.array([df.get(at, 0) for at in range(vocabulary)], dtype=np.float64)
    return np.where(held > 0, np.floor(1000 * np.log((2 * total + 2) / (2 * held + 1))), 0).astype(np.int64)


def _weighed(counted: DataFrame, weights: np.ndarray, total: int, length: int) -> DataFrame:
    """(doc_id, norm, terms, impacts) of documents with id that hold a vocabulary term."""
    shared = counted.sparkSession.sparkContext.broadcast(weights)

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["terms"].map(len).to_numpy()
            terms, tf = np.concatenate(batch["terms"].tolist()), np.concatenate(batch["tf"].tolist()).astype(np.int64)
            m = np.repeat(batch["m"].to_numpy(dtype=np.int64), sizes)
            impacts = shared.value[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            norm = np.sqrt(np.add.reduceat(impacts.astype(np.float64) ** 2, starts))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "norm": norm, "terms": batch["terms"], "impacts": np.split(impacts, starts[1:])})

    # 90 * n * total may need more than 64 bits.
    m = (F.lit(10) + F.floor(F.expr(f"CAST(90 * n AS DECIMAL(18,0)) * CAST({total} AS DECIMAL(18,0)) div CAST({length} AS DECIMAL(18,0))"))).cast("long")
    rows = counted.where(F.col("doc_id").isNotNull() & (F.size("terms") > 0)).select("doc_id", m.alias("m"), "terms", "tf")
    return rows.mapInPandas(weigh, "doc_id long, norm double, terms array<int>, impacts array<long>")


class _Bucket:
    """Vectors of similar length, longest first, by coordinate."""

    def __init__(self, ids: np.ndarray, norms: np.ndarray, terms: list[np.ndarray], impacts: list[np.ndarray]) -> None:
        self.ids, self.norms = ids, norms
        rows = np.repeat(np.arange(len(ids)), [len(own) for own in terms])
        every, impact = np.concatenate(terms), np.concatenate(impacts)
        order = np.argsort(every, kind="stable")
        self.rows, self.impact = rows[order], impact[order]
        self.terms, first = np.unique(every[order], return_index=True)
        self.first = np.append(first, len(order))
        self.largest = np.maximum.reduceat(self.impact, first)

    def found(self, item: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that reach ``bound`` (and more than 0) with an item, and their exact scores."""
        nothing = np.array([], dtype=np.int64)
        places = np.minimum(np.searchsorted(self.terms, item), len(self.terms) - 1)
        places = places[self.terms[places] == item]
        if not len(places):
            return nothing, nothing
        places = places[np.argsort(-self.largest[places], kind="stable")]
        # Most that the terms from each place on can add; documents that hold none of the terms before stay below the bound.
        left = np.cumsum(self.largest[places][::-1])[::-1]
        needed = int(np.count_nonzero(left >= bound))
        if not needed:
            return nothing, nothing
        have = np.zeros(len(self.ids), dtype=np.int64)
        for at in places[:needed]:
            part = slice(self.first[at], self.first[at + 1])
            have[self.rows[part]] += self.impact[part]
        rest = len(places) - needed
        if rest:
            most = np.minimum(float(left[needed]), np.sqrt(rest) * self.norms) * _SLACK
            rows = np.flatnonzero((have > 0) & (have + most >= bound))
        else:
            rows = np.flatnonzero(have > 0)
        scores = np.zeros(len(rows), dtype=np.int64)
        for at in places:
            own = self.rows[self.first[at] : self.first[at + 1]]
            spot = np.minimum(np.searchsorted(own, rows), len(own) - 1)
            scores += np.where(own[spot] == rows, self.impact[self.first[at] + spot], 0)
        good = (scores > 0) & (scores >= bound)
        return rows[good], scores[good]


def _searched(bucket: _Bucket, items: list[tuple[str, np.ndarray]], reach: np.ndarray, bounds: np.ndarray, k: int, best: Best) -> None:
    """Put a bucket's documents into ``best`` and raise the bounds."""
    for number in np.flatnonzero(reach * bucket.norms[0] * _SLACK >= bounds):
        rows, scores = bucket.found(items[number][1], int(bounds[number]))
        if not len(rows):
            continue
        ids = bucket.ids[rows]
        if number in best:
            scores, ids = np.concatenate([best[number][0], scores]), np.concatenate([best[number][1], ids])
        order = np.lexsort((ids, -scores))[:k]
        best[number] = scores[order], ids[order]
        if len(order) == k:
            bounds[number] = max(bounds[number], scores[order[-1]])


def _search(laid_out: DataFrame, items: list[tuple[str, np.ndarray]], bounds: np.ndarray, k: int) -> DataFrame:
    """(item_id, doc_id, score): at most k rows per item and task."""
    shared = laid_out.sparkSession.sparkContext.broadcast((items, bounds))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, bounds = shared.value[0], shared.value[1].copy()
        reach = np.sqrt([len(terms) for _, terms in items])
        best: Best = {}
        for batch in batches:
            batch = batch.sort_values("norm", ascending=False, kind="stable")  # a task may read the ends of two runs
            for at in range(0, len(batch), BUCKET_ROWS):
                part = batch.iloc[at : at + BUCKET_ROWS]
                if not (reach * part["norm"].iloc[0] * _SLACK >= bounds).any():
                    break  # what follows is shorter still
                _searched(_Bucket(part["doc_id"].to_numpy(), part["norm"].to_numpy(), part["terms"].tolist(), part["impacts"].tolist()),
                          items, reach, bounds, k, best)
        for number, (scores, ids) in best.items():
            yield pd.DataFrame({"item_id": items[number][0], "doc_id": ids, "score": scores})

    return laid_out.mapInPandas(search, "item_id string, doc_id long, score long")


def _first_bounds(laid_out: DataFrame, items: list[tuple[str, np.ndarray]], k: int) -> np.ndarray:
    """k-th best score of every item among the seed rows, 1 where these hold fewer."""
    few = laid_out.where(drawn(F.col("doc_id"), SEED_ROWS, laid_out.count())).dropDuplicates(["doc_id"])
    seeds = few.repartition(1).sortWithinPartitions(F.desc("norm"))
    found = _search(seeds, items, np.ones(len(items), dtype=np.int64), k)
    full = found.groupBy("item_id").agg(F.count("*").alias("n"), F.min("score").alias("bound")).where(F.col("n") >= k)
    known = {row["item_id"]: row["bound"] for row in full.collect()}
    return np.array([known.get(item_id, 1) for item_id, _ in items], dtype=np.int64)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                   item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of every item."""
    spark, kind = docs.sparkSession, items.schema[item_id].dataType
    asked = cut_lineage(item_terms(items, item_id, item_text))
    blocks = max(1, -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // BLOCK_TERMS))
    asked = asked.withColumn("block", F.pmod(F.xxhash64(F.col("item_id").cast("string")), F.lit(blocks)))
    found = spark.createDataFrame([], "item_id string, doc_id long, score long")
    for block in range(blocks):
        own = [(row["item_id"], row["terms"]) for row in asked.where(F.col("block") == block).select(F.col("item_id").cast("string"), "terms").collect()]
        vocabulary = sorted({term for _, terms in own for term in terms})
        counted = _counted(docs, vocabulary, doc_id, text)
        total, length = counted.agg(F.count("*"), F.sum("n")).first()
        if not total:
            break
        weights = _weights(counted, len(vocabulary), total)
        number = {term: at for at, term in enumerate(vocabulary)}
        sets = [(i, np.array([number[term] for term in terms], dtype=np.int64)) for i, terms in own]
        weighed = _weighed(counted, weights, total, length)
        laid_out = cut_lineage(weighed.repartitionByRange(F.desc("norm"), F.col("doc_id")).sortWithinPartitions(F.desc("norm"), "doc_id"))
        found = found.unionByName(_search(laid_out, sets, _first_bounds(laid_out, sets, k), k))
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score")


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH words AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+') AS ws FROM documents),
sized AS (SELECT rid, doc_id, CAST(len(ws) AS BIGINT) AS n FROM words WHERE len(ws) > 0),
size AS (SELECT count(*) AS total, CAST(sum(n) AS BIGINT) AS length FROM sized),
tfs AS (SELECT rid, t, count(*) AS tf FROM words, unnest(ws) AS u(t) GROUP BY rid, t),
asked AS (
  SELECT DISTINCT item_id, t
  FROM benchmark, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS u(t) WHERE item_id IS NOT NULL),
weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * total + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM tfs GROUP BY t), size),
scored AS (
  SELECT item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * total) // length)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (t) JOIN tfs USING (t) JOIN sized USING (rid), size WHERE doc_id IS NOT NULL GROUP BY item_id, rid, doc_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
