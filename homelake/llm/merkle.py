"""Merkle manifest of a dataset, and a recursive query that climbs it from every leaf.

Rows are leaves; per group they ascend by id and are hashed in runs of two, level by level, up to a subroot; the subroots, in order of their
groups, are hashed likewise up to the root.  A digest is the SHA-256 of its inputs; digests enter as lower-case hex text.

Stored levels: a row holds a node's ``FAN`` descendants ``DEPTH`` levels down with all levels between (``levels``), its own digest (``top``) and a
link to the row above, where it is one of those descendants; the last row of a group links to the tree of subroots.  So a million leaves are three
rows high.

The climb is one recursive query over those rows.  Its rows carry neighbouring leaves (``FAN`` at most, which share everything above
their lowest row); each step appends the siblings that the joined row holds and folds them into every leaf's claimed digest, until there is no link.
What it carries per leaf is one digest a step; a leaf's own siblings are left behind in the step that met them, siblings above are carried once.

Everything is partitioned by ranges and rows of ``FAN``; no task holds a group.  Defined results: null fields count as ``-``; null groups are one group
and the first; rows without id come first; rows of one id are leaves each, in order of their digests; an empty table has no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homelake.llm.common import placed, table
from homelake.session import cut_lineage

DEPTH = 8
FAN = 1 << DEPTH
# Number of the tree of subroots.
TOP = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(*fields: Column) -> Column:
    """Digest of fields, each as its UTF-8 length, a colon and its value, or ``-`` if null."""
    texts = [field.cast("string") for field in fields]
    parts = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _parents(nodes: Column) -> Column:
    pair = lambda at: F.concat(_hex(F.get(nodes, 2 * at)), F.coalesce(_hex(F.get(nodes, 2 * at + 1)), F.lit("")))
    last = F.floor((F.size(nodes) - 1) / 2).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda at: F.unhex(F.sha2(pair(at), 256)))


def _linked(rows: DataFrame, stratum: int) -> DataFrame:
    """Rows of one stratum: levels, top and the link upwards, from (tree, page, height, nodes) with at most ``FAN`` nodes each."""
    depth = F.least(F.greatest(F.col("height") - stratum * DEPTH, F.lit(0)), F.lit(DEPTH)).cast("int")
    steps = F.slice(F.sequence(F.lit(1), F.lit(DEPTH)), F.lit(1), depth)
    levels = F.aggregate(steps, F.array("nodes"), lambda done, _: F.concat(done, F.array(_parents(F.element_at(done, -1)))))
    more, group = F.col("height") > (stratum + 1) * DEPTH, F.col("tree") != TOP
    place = F.when(more, F.col("page")).when(group, F.col("tree"))
    return rows.withColumn("levels", levels).withColumn("stratum", F.lit(stratum)).withColumns({
        "top": F.element_at(F.element_at("levels", -1), 1),
        "up_tree": F.when(more, F.col("tree")).when(group, F.lit(TOP).cast("long")), "up_stratum": F.when(more, stratum + 1).when(group, 0),
        "up_page": F.shiftright(place, DEPTH), "up_at": place.bitwiseAND(FAN - 1).cast("int"),
    })


def _height(rows: Column) -> Column:
    """Levels above the leaves until one node remains."""
    return F.when(rows <= 1, 0).otherwise(F.length(F.bin(rows - 1)))


def _strata(lowest: DataFrame) -> list[DataFrame]:
    """All strata of stored rows, from the lowest one (tree, page, height, nodes) up."""
    strata = [cut_lineage(_linked(lowest, 0).drop("nodes"))]
    highest = strata[0].agg(F.max("height")).first()[0] or 0
    while highest > len(strata) * DEPTH:
        below = strata[-1].where(F.col("up_tree") == F.col("tree"))
        nodes = below.groupBy("tree", F.col("up_page").alias("page")).agg(
            F.max("height").alias("height"), F.array_sort(F.collect_list(F.struct("up_at", "top"))).alias("sorted"))
        rows = nodes.select("tree", "page", "height", F.col("sorted.top").alias("nodes"))
        strata.append(cut_lineage(_linked(rows, len(strata)).drop("nodes")))
    return strata


def build_manifest(leaves: DataFrame, group: str, order: str, claimed: str = "leaf") -> tuple[DataFrame, DataFrame]:
    """(bundles, pages) of ``leaves``, which has a hex digest ``leaf``, one to check in ``claimed``, a group and an id to order by.

    ``bundles``: tree, page and up to ``FAN`` neighbouring leaves (id, leaf, claimed); ``pages``: the stored, linked rows.
    """
    # Digests are kept as bytes, half their text.
    slim = cut_lineage(leaves.select(F.col(group).alias("group"), F.col(order).alias("id"), F.unhex("leaf").alias("leaf"), F.unhex(claimed).alias("claimed")))
    places = placed(slim, "group", ["id", "leaf"], "tree", "place", "leaves")
    runs = places.groupBy("tree", F.shiftright("place", DEPTH).alias("page")).agg(
        _height(F.max("leaves")).alias("height"), F.array_sort(F.collect_list(F.struct("place", "id", "leaf", "claimed"))).alias("run"))
    bundles = cut_lineage(runs)
    strata = _strata(bundles.select("tree", "page", "height", F.col("run.leaf").alias("nodes")))
    tops = strata[0].where(F.col("up_tree") == TOP)
    for rows in strata[1:]:
        tops = tops.unionByName(rows.where(F.col("up_tree") == TOP))
    groups = tops.count()
    subroots = tops.groupBy(F.col("up_page").alias("page")).agg(F.array_sort(F.collect_list(F.struct("up_at", "top"))).alias("sorted"))
    lowest = subroots.select(F.lit(TOP).cast("long").alias("tree"), "page", _height(F.lit(groups)).alias("height"), F.col("sorted.top").alias("nodes"))
    pages = strata[0]
    for rows in strata[1:] + _strata(lowest):
        pages = pages.unionByName(rows)
    return bundles, pages


# Siblings of place k in a row's levels, lowest first, and the fold of a digest through them.
_LEVELS = "slice(sequence(0, 7), 1, size(p.levels) - 1)"
_SIBLING = "get(get(p.levels, l), shiftright({k}, l) ^ 1)"
_SIBLINGS = f"filter(transform({_LEVELS}, l -> {_SIBLING}), s -> s IS NOT NULL)"
_FOLD = f"""aggregate({_LEVELS}, h, (x, l) -> unhex(sha2(CASE WHEN shiftright({{k}}, l) % 2 = 1
  THEN concat(lower(hex({_SIBLING})), lower(hex(x))) ELSE concat(lower(hex(x)), coalesce(lower(hex({_SIBLING})), '')) END, 256)))"""

CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT tree AS first_tree, page AS first_page, tree, 0 AS stratum, page, CAST(NULL AS INT) AS at, run.claimed AS hashes,
    CAST(NULL AS ARRAY<ARRAY<BINARY>>) AS own, CAST(array() AS ARRAY<BINARY>) AS above, CAST(NULL AS BINARY) AS subroot, CAST(NULL AS BINARY) AS root
  FROM {{bundles}}
  UNION ALL
  SELECT c.first_tree, c.first_page, p.up_tree, p.up_stratum, p.up_page, p.up_at,
    transform(c.hashes, (h, i) -> {_FOLD.format(k="coalesce(c.at, i)")}),
    CASE WHEN c.at IS NULL THEN transform(c.hashes, (h, i) -> {_SIBLINGS.format(k="i")}) END,
    CASE WHEN c.at IS NULL THEN c.above ELSE concat(c.above, {_SIBLINGS.format(k="c.at")}) END,
    coalesce(c.subroot, CASE WHEN p.up_tree = {TOP} THEN p.top END), CASE WHEN p.up_tree IS NULL THEN p.top END
  FROM climb AS c JOIN {{pages}} AS p ON c.tree = p.tree AND c.stratum = p.stratum AND c.page = p.page)
SELECT first_tree, first_page, hashes, own, above, subroot, root FROM climb WHERE own IS NOT NULL OR root IS NOT NULL
"""
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def climb(bundles: DataFrame, pages: DataFrame) -> DataFrame:
    """id, leaf, subroot, root, siblings (array, left to right and upwards) and folded root of every leaf; digests as bytes."""
    spark = bundles.sparkSession
    limit = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, -1)  # the rows of a climb grow with the leaves
    try:
        climbed = cut_lineage(spark.sql(CLIMB, bundles=bundles, pages=pages))
    finally:
        spark.conf.set(_ROW_LIMIT, limit)
    low = climbed.where("own IS NOT NULL").select(F.col("first_tree").alias("tree"), F.col("first_page").alias("page"), "own")
    high = climbed.where("root IS NOT NULL").select(
        F.col("first_tree").alias("tree"), F.col("first_page").alias("page"), "hashes", "above", "subroot", "root")
    met = bundles.select("tree", "page", "run").join(low, ["tree", "page"]).join(high, ["tree", "page"])
    each = met.select("subroot", "root", "above", F.explode(F.arrays_zip("run", "own", "hashes")).alias("of"))
    return each.select(
        F.col("of.run.id").alias("id"), F.col("of.run.leaf").alias("leaf"), "subroot", "root", F.concat("of.own", "above").alias("siblings"),
        F.col("of.hashes").alias("folded"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
    other = leaf_digest(*[more if name == "n_chars" else F.col(name) for name in FIELDS])
    leaves = docs.select("doc_id", "lang", leaf_digest(*map(F.col, FIELDS)).alias("leaf"), F.when(tampered, other).alias("other"))
    bundles, pages = build_manifest(leaves.withColumn("claimed", F.coalesce("other", "leaf")), "lang", "doc_id", "claimed")
    proof = F.sha2(F.array_join(F.transform("siblings", _hex), ""), 256)
    return climb(bundles, pages).select(
        F.col("id").alias("doc_id"), *[_hex(F.col(name)).alias(name) for name in ("leaf", "subroot", "root")], proof.alias("proof_sha256"),
        _hex(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


ORACLE = """
WITH RECURSIVE fields AS (
  SELECT row_number() OVER () AS rid, * FROM documents),
docs AS (
  SELECT rid, doc_id, lang, a || n || z AS plain, a || coalesce(CAST(strlen(CAST(more AS VARCHAR)) AS VARCHAR) || ':' || CAST(more AS VARCHAR), '-') || z AS changed
  FROM (SELECT rid, doc_id, lang, CAST(n_chars AS HUGEINT) + 1 AS more,
    coalesce(CAST(strlen(CAST(doc_id AS VARCHAR)) AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR), '-')
    || coalesce(CAST(strlen(source) AS VARCHAR) || ':' || source, '-') || coalesce(CAST(strlen(lang) AS VARCHAR) || ':' || lang, '-') AS a,
    coalesce(CAST(strlen(CAST(n_chars AS VARCHAR)) AS VARCHAR) || ':' || CAST(n_chars AS VARCHAR), '-') AS n,
    coalesce(CAST(strlen(text) AS VARCHAR) || ':' || text, '-') AS z FROM fields)),
crc AS (
  SELECT k, list_reduce([CAST(k AS BIGINT), 1, 2, 3, 4, 5, 6, 7, 8],
    lambda v, x: CASE WHEN v % 2 = 1 THEN xor(v >> 1, CAST(3988292384 AS BIGINT)) ELSE v >> 1 END) AS v FROM range(256) AS r(k)),
bits AS (  -- CRC-32 of the decimal id, byte by byte
  SELECT rid, CAST(doc_id AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS c FROM docs WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT rid, s, i + 1, xor(c >> 8, t.v) FROM bits JOIN crc AS t ON t.k = xor(c & 255, ascii(s[i + 1])) WHERE i < length(s)),
tampered AS (SELECT rid FROM bits WHERE i = length(s) AND xor(c, CAST(4294967295 AS BIGINT)) % 7 = 0),
leaves AS (
  SELECT docs.rid, doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, sha256(plain)) - 1 AS pos, sha256(plain) AS leaf,
    CASE WHEN tampered.rid IS NULL THEN sha256(plain) ELSE sha256(changed) END AS claimed
  FROM docs LEFT JOIN tampered ON tampered.rid = docs.rid),
low AS (
  SELECT tree, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS width FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (width + 1) // 2 FROM low WHERE width > 1
  GROUP BY tree, level, pos // 2, width),
subroots AS (SELECT tree, h FROM low WHERE width = 1),
high AS (
  SELECT 0 AS level, tree AS pos, h, (SELECT count(*) FROM subroots) AS width FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (width + 1) // 2 FROM high WHERE width > 1 GROUP BY level, pos // 2, width),
climb AS (
  SELECT rid, tree, 0 AS level, pos, claimed AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT c.rid, c.tree, c.level + 1, c.pos // 2, CASE WHEN c.pos % 2 = 1 THEN sha256(s.h || c.h) ELSE sha256(c.h || coalesce(s.h, '')) END,
    c.proof || coalesce(s.h, '')
  FROM climb AS c JOIN low AS n ON n.tree = c.tree AND n.level = c.level AND n.pos = c.pos AND n.width > 1
  LEFT JOIN low AS s ON s.tree = c.tree AND s.level = c.level AND s.pos = xor(c.pos, 1)),
heights AS (SELECT tree, level FROM low WHERE width = 1),
rise AS (
  SELECT c.rid, 0 AS level, c.tree AS pos, c.h, c.proof FROM climb AS c JOIN heights AS t ON t.tree = c.tree AND t.level = c.level
  UNION ALL
  SELECT c.rid, c.level + 1, c.pos // 2, CASE WHEN c.pos % 2 = 1 THEN sha256(s.h || c.h) ELSE sha256(c.h || coalesce(s.h, '')) END,
    c.proof || coalesce(s.h, '')
  FROM rise AS c JOIN high AS n ON n.level = c.level AND n.pos = c.pos AND n.width > 1
  LEFT JOIN high AS s ON s.level = c.level AND s.pos = xor(c.pos, 1)),
root AS (SELECT level, h FROM high WHERE width = 1)
SELECT doc_id, leaf, subroots.h AS subroot, root.h AS root, sha256(proof) AS proof_sha256, rise.h AS folded_root, rise.h = root.h AS verified
FROM leaves JOIN subroots USING (tree) JOIN rise USING (rid) JOIN root ON root.level = rise.level
"""
