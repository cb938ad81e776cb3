"""Near-duplicate groups from bottom-k sketches of one hash function.

1. Every text becomes the set of its hashed word shingles; equal sets form a class (copies never meet pairwise).  A class keeps its
   ``SKETCH`` smallest hashes and an odd sketch (parities of 512 hash slots), nothing else.
2. Inverted lists of the retained values.  Two sets of similarity 0.85 share at least ``SHARED`` of 32 retained values (all but about one pair
   in 10^9).  So each class needs only its rarest ``SKETCH - SHARED + 1`` values, counted over the corpus, to meet every partner: values
   of common passages drop out first.  A set of up to 32 shingles retains all of them and needs fewer: always enough to meet a partner
   that is whole as well, or one that is cut to its sketch.
3. Each list first meets its most central member only.  What that links is one component, so in the second round only members of
   different components of a list meet, cut into blocks where the list is long.
4. Pairs are filtered by size, by odd sketch and by the union-sketch estimate, then confirmed on full sets.  Components come from contracting
   the links.

Defined results: a null or empty text has no shingles and links with nothing, nor does a row without doc_id (its component is null and
it is kept).  Repeated rows get the same component.  A third of all rows in one class or list is split (salts, adaptive skew joins).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homelake.llm.common import table
from homelake.session import cut_lineage

SHINGLE_WORDS = 5
SKETCH = 32
SHARED = 12
SLOTS = 512
LIST_BLOCK = 1_000
_CACHED_WORDS = 500_000
_LEVEL_SIZE = 128
_ODD = [f"odd{i}" for i in range(SLOTS // 64)]
_NEXT = [f"next{i}" for i in range(SLOTS // 64)]


class _WordHashes(dict):
    """Hash of each word, computed once; holds a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(text: str | None, words_of: _WordHashes, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Ascending distinct hashes of the word shingles; fewer words than ``width`` make one shingle."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.array([], dtype=np.uint64)
    codes = np.array([words_of[word] for word in words], dtype=np.uint64)
    span = min(width, len(codes))
    mixed = np.full(len(codes) - span + 1, span, dtype=np.uint64)
    for i in range(span):
        mixed ^= codes[i : i + len(mixed)]
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def _signed(values: np.ndarray) -> np.ndarray:
    return (values ^ np.uint64(1 << 63)).view(np.int64)  # keeps the order


def _odd_sketch(hashes: np.ndarray, level: int) -> np.ndarray:
    """Parities of the hash slots of every 2**level-th hash, as longs."""
    own = hashes[(hashes & np.uint64((1 << level) - 1)) == 0]
    parity = np.bincount(((own >> np.uint64(24)) & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def sketches(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, set_key, n_shingles, level, sketch, odd, next) of every row; no text."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words_of = _WordHashes()
        for batch in batches:
            rows = []
            for value in batch["text"]:
                hashes = shingle_hashes(value, words_of)
                level = max(0, (len(hashes) // _LEVEL_SIZE).bit_length() - 1)
                rows.append((
                    xxhash.xxh3_128_digest(hashes.tobytes()), len(hashes), level, _signed(hashes[:SKETCH]),
                    _odd_sketch(hashes, level), _odd_sketch(hashes, level + 1),
                ))
            out = pd.DataFrame(rows, columns=["set_key", "n_shingles", "level", "sketch", "odd", "next"], index=batch.index)
            out.insert(0, "doc_id", batch["doc_id"])
            yield out

    schema = "doc_id long, set_key binary, n_shingles long, level int, sketch array<long>, odd array<long>, next array<long>"
    return docs.select("doc_id", F.col(text).alias("text")).mapInPandas(sketch, schema)


def _prefix(size: Column, percent: int) -> Column:
    """How many of a class's rarest retained values it must show to meet every partner."""
    # A partner of more than SKETCH shingles shows only that many: the largest one that may link lacks the others.
    cut_off = F.floor(size * 100 / percent) - SKETCH
    whole = size - F.least(F.ceil(size * percent / 100), size - cut_off) + 1
    return F.when(size <= SKETCH, whole).otherwise(F.lit(SKETCH - SHARED + 1)).cast("int")


def _may_link(percent: int) -> Column:
    """Size and odd-sketch test of a pair of rows a and b; passes every pair of the wanted similarity."""
    low, high = F.least("a.n_shingles", "b.n_shingles"), F.greatest("a.n_shingles", "b.n_shingles")
    # Similarity s means at most (1 - s) / (1 + s) of both sizes' sum in the symmetric difference.
    most = (F.col("a.n_shingles") + F.col("b.n_shingles")) * ((100 - percent) / (100 + percent))
    level = F.greatest("a.level", "b.level")
    sampled = most / F.pow(F.lit(2.0), level)
    bound = F.when(level == 0, sampled).otherwise(sampled + 6 * F.sqrt(sampled) + 4)

    def differing(left: list[str], right: list[str]) -> Column:
        return reduce(lambda x, y: x + y, [F.bit_count(F.col(f"a.{x}").bitwiseXOR(F.col(f"b.{y}"))) for x, y in zip(left, right)])

    bits = (
        F.when(F.col("a.level") == F.col("b.level"), differing(_ODD, _ODD))
        .when(F.col("a.level") < F.col("b.level"), differing(_NEXT, _ODD))
        .otherwise(differing(_ODD, _NEXT))
    )
    return (low * 100 >= high * percent) & (bits <= bound)


def _estimate_passes(percent: int) -> Column:
    """Union-sketch estimate of the similarity of a and b, with room for six standard errors."""
    union = F.slice(F.array_sort(F.array_union("a.sketch", "b.sketch")), 1, SKETCH)
    both = F.size(F.array_intersect(F.array_intersect(union, F.col("a.sketch")), F.col("b.sketch")))
    share = percent / 100
    return both >= F.floor(F.size(union) * share - 6 * F.sqrt(F.size(union) * share * (1 - share)))


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, text: str, percent: int) -> DataFrame:
    """Pairs (a, b) of class keys whose full sets reach the similarity; sets are made anew from the texts of these classes."""
    columns = ["set_key", "n_shingles", "level", "sketch", *_ODD, *_NEXT]
    known = classes.select(*columns)
    screened = (
        pairs.join(known.alias("a"), F.col("a.set_key") == F.col("a_key"))
        .join(known.alias("b"), F.col("b.set_key") == F.col("b_key"))
        .where(_may_link(percent) & _estimate_passes(percent)).select("a_key", "b_key")
    )
    screened = cut_lineage(screened)
    wanted = screened.select(F.col("a_key").alias("set_key")).union(screened.select("b_key")).distinct()
    ids = wanted.join(classes.select("set_key", "doc_id"), "set_key").select("doc_id").distinct()

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words_of = _WordHashes()
        for batch in batches:
            hashes = [shingle_hashes(value, words_of) for value in batch["text"]]
            yield pd.DataFrame({"set_key": [xxhash.xxh3_128_digest(x.tobytes()) for x in hashes], "hashes": [_signed(x) for x in hashes]})

    texts = docs.select("doc_id", F.col(text).alias("text")).join(ids, "doc_id")
    full = cut_lineage(texts.mapInPandas(sets, "set_key binary, hashes array<long>").join(wanted, "set_key", "left_semi")
                       .dropDuplicates(["set_key"]))

    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            linked = []
            for a, b in zip(batch.pop("a_set"), batch.pop("b_set")):
                shared = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * shared >= percent * (len(a) + len(b) - shared))
            yield batch[np.array(linked, dtype=bool)]

    both = (
        screened.join(full.select(F.col("set_key").alias("a_key"), F.col("hashes").alias("a_set")), "a_key")
        .join(full.select(F.col("set_key").alias("b_key"), F.col("hashes").alias("b_set")), "b_key")
        .select("a_key", "b_key", "a_set", "b_set")
    )
    return cut_lineage(both.mapInPandas(confirm, "a_key binary, b_key binary"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a_key, b_key); root is the smallest node of the component.

    Each round every node hooks to its smallest neighbour, chains are shortened by pointer jumping, and the links are
    contracted to roots, until none is left.
    """
    found = None
    edges = cut_lineage(links.select(F.col("a_key").alias("a"), F.col("b_key").alias("b")).distinct())
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hooks = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
        while True:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("__up"))
            jumped = cut_lineage(hooks.join(up, "root").select("node", F.col("__up").alias("root"), (F.col("__up") != F.col("root")).alias("moved")))
            hooks, moved = jumped.drop("moved"), jumped.where("moved")
            if moved.isEmpty():
                break
        if found is None:
            found = hooks
        else:
            further = hooks.select(F.col("node").alias("root"), F.col("root").alias("__up"))
            found = cut_lineage(found.join(further, "root", "left").select("node", F.coalesce("__up", "root").alias("root")))
        a, b = hooks.toDF("a", "a_root"), hooks.toDF("b", "b_root")
        contracted = edges.join(a, "a").join(b, "b").where("a_root != b_root").select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
        edges = cut_lineage(contracted.distinct())
    return edges.toDF("node", "root") if found is None else found


def near_duplicates(docs: DataFrame, text: str = "text", percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text).

    Texts are linked where 100 * shared shingles >= ``percent`` * distinct shingles of both; 80 is the least ``percent`` that ``SHARED`` covers.
    """
    rows = cut_lineage(sketches(docs, text))
    linked = rows.where("doc_id is not null and n_shingles > 0")
    first = linked.groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    slim = linked.select("set_key", "doc_id", "n_shingles", "level", "sketch",
                         *[F.col("odd")[i].alias(name) for i, name in enumerate(_ODD)],
                         *[F.col("next")[i].alias(name) for i, name in enumerate(_NEXT)])
    classes = slim.join(first.select("set_key", "doc_id"), ["set_key", "doc_id"]).dropDuplicates(["set_key"])
    classes = cut_lineage(classes)
    values = classes.select("set_key", F.explode("sketch").alias("value"))

    # Values that several classes hold, and how many; of each class the rarest ones that its prefix has room for.
    common = values.groupBy("value").agg(F.count("*").alias("classes")).where("classes > 1")
    shared = values.join(common, "value")
    own = Window.partitionBy("set_key")
    ranked = cut_lineage(
        shared.withColumns({
            "rank": F.row_number().over(own.orderBy("classes", "value")),
            "earlier": F.collect_list("value").over(own.orderBy("classes", "value").rowsBetween(Window.unboundedPreceding, -1)),
            "others": F.count("*").over(own), "central": F.sum("classes").over(own),
        })
    )
    sizes = classes.select("set_key", "n_shingles")
    prefix = _prefix(F.col("n_shingles"), percent) - (F.least("n_shingles", F.lit(SKETCH)) - F.col("others"))
    entries = ranked.join(sizes, "set_key").where(F.col("rank") <= prefix).select("value", "set_key", "central", "earlier")
    hubs = entries.groupBy("value").agg(F.max(F.struct("central", "set_key")).alias("hub"), F.count("*").alias("length")).where("length > 1")
    hubs = cut_lineage(hubs.select("value", F.col("hub.set_key").alias("hub"), "length"))
    entries = cut_lineage(entries.join(hubs, "value"))

    # First round: each list's members and its most central one.
    to_hub = entries.where("set_key != hub").select(F.least("set_key", "hub").alias("a_key"), F.greatest("set_key", "hub").alias("b_key")).distinct()
    links = _confirmed(to_hub, classes, docs, text, percent)
    roots = components(links)

    # Second round: members of one list that are still apart.  The order of a class's values is the same in all classes, so a pair
    # that shares an earlier value has met there already.
    attributes = classes.select("set_key", "n_shingles", "level", *_ODD, *_NEXT)
    placed = (
        entries.join(roots.withColumnRenamed("node", "set_key"), "set_key", "left")
        .withColumn("root", F.coalesce("root", "set_key"))
    )
    mixed = placed.groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("value")
    apart = cut_lineage(placed.join(mixed, "value", "left_semi").join(attributes, "set_key"))
    parts = F.ceil(F.col("length") / LIST_BLOCK).cast("int")
    left = apart.withColumn("part", F.pmod(F.xxhash64("set_key"), parts).cast("int"))
    right = apart.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    meeting = (F.col("a.value") == F.col("b.value")) & (F.col("a.part") == F.col("b.part")) & (F.col("a.set_key") < F.col("b.set_key"))
    pairs = (
        left.alias("a").join(right.alias("b"), meeting & (F.col("a.root") != F.col("b.root")) & _may_link(percent)
                             & ~F.arrays_overlap("a.earlier", "b.earlier"))
        .select(F.col("a.set_key").alias("a_key"), F.col("b.set_key").alias("b_key")).distinct()
    )
    roots = components(links.union(_confirmed(pairs, classes, docs, text, percent)))

    # Smallest doc_id of each component, back to the rows.
    roots = roots.withColumnRenamed("node", "set_key")
    members = first.join(roots, "set_key", "left").withColumn("root", F.coalesce("root", "set_key"))
    lowest = members.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.sum("copies").alias("rows"))
    placed = members.join(lowest.where("rows > 1"), "root").select("set_key", "component_id")
    found = rows.select("doc_id", "set_key", "n_shingles").join(placed, "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x{09}-\x{0D}\x{20}]+'), lambda w: w <> '') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT rid, array_to_string(words[s:s + 4], ' ') AS shingle
  FROM docs, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS u(s) WHERE len(words) > 0),
sizes AS (SELECT rid, count(*) AS n FROM shingles GROUP BY rid),
shared AS (SELECT a.rid AS x, b.rid AS y, count(*) AS common FROM shingles AS a JOIN shingles AS b USING (shingle) WHERE a.rid <> b.rid GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes AS a ON a.rid = x JOIN sizes AS b ON b.rid = y WHERE 100 * common >= 85 * (a.n + b.n - common)),
reached(rid, other) AS (SELECT rid, rid FROM docs UNION SELECT r.rid, l.y FROM reached AS r JOIN links AS l ON r.other = l.x),
lowest AS (SELECT r.rid, min(doc_id) AS component_id FROM reached AS r JOIN docs AS o ON o.rid = r.other GROUP BY r.rid)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM docs JOIN lowest USING (rid) LEFT JOIN sizes USING (rid)
"""
