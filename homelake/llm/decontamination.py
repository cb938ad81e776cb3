"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

An item's windows of ``WINDOW`` consecutive words (all its words, if it has fewer) are the patterns.  Words are lower-cased ASCII letters,
digits and anything beyond ASCII; texts and patterns are joined with single spaces, so a window matches whole words only.  The text is scanned
once, and the matched words are mapped back to offsets of the original text.

Items are brought to the executors in blocks of at most ``BLOCK_CHARS`` pattern characters; each block is one pass over the texts, which carry
their matches along.  A usual benchmark is one block.  Texts are scanned where they lie; nothing is shuffled.

Defined results: a null text or item has no words; an item without words or without id is no item; repeated items count once; a
repeated document row is scanned for itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homelake.llm.common import table
from homelake.session import cut_lineage

WINDOW = 10
BLOCK_CHARS = 4_000_000
# ASCII without digits and letters separates words; capitals become small letters; other bytes stay.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def folded_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split(b" ") if text else []


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(pattern, item_ids) of all distinct windows; Spark splits and shuffles them."""
    lower = F.regexp_replace(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    words = F.filter(F.split(lower, " "), lambda word: word != "")
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (WINDOW - 1), F.lit(1)))
    return (
        items.where(F.col(item_id).isNotNull() & F.col(text).isNotNull())
        .select(F.col(item_id).cast("string").alias("item_id"), words.alias("words")).where(F.size("words") > 0)
        .select("item_id", F.explode(F.transform(starts, lambda at: F.array_join(F.slice("words", at, WINDOW), " "))).alias("pattern"))
        .groupBy("pattern").agg(F.collect_set("item_id").alias("item_ids"))
    )


def _scanner(shared, text: str, prefix: str):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = ahocorasick.Automaton()
        for pattern, item_ids in shared.value:
            automaton.add_word(f" {pattern} ", (pattern.count(" ") + 1, item_ids))
        automaton.make_automaton()
        for batch in batches:
            spans, found, words = [], [], []
            for content, before, items in zip(batch[text], batch[f"{prefix}spans"], batch[f"{prefix}item_ids"]):
                parts = [word for word in folded_words(content) if word]
                words.append(len(parts))
                line = f" {b' '.join(parts).decode('utf-8', 'surrogatepass')} " if parts else ""
                hits = [(end, length, ids) for end, (length, ids) in automaton.iter(line)] if line and len(automaton) else []
                if not hits:
                    spans.append(before)
                    found.append(items)
                    continue
                # The end of a match is the space after its last word: the number of spaces up to there is that word's number.
                spaces = np.flatnonzero(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) == 32)
                last = np.searchsorted(spaces, [end for end, _, _ in hits])
                marks = np.zeros(len(parts) + 1, dtype=np.int64)
                np.add.at(marks, last - [length for _, length, _ in hits], 1)
                np.add.at(marks, last, -1)
                for span in before:
                    marks[span["first_word"]] += 1
                    marks[span["last_word"] + 1] -= 1
                hit = np.concatenate([[0], np.cumsum(marks[:-1]) > 0, [0]]).astype(np.int8)
                edges = np.diff(hit)
                starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
                places = [found_.span() for found_ in _WORD.finditer(content)]
                spans.append([
                    {"first_word": int(a), "last_word": int(b) - 1, "start": places[a][0], "end": places[b - 1][1]} for a, b in zip(starts, ends)
                ])
                found.append(sorted({*items, *(item for _, _, ids in hits for item in ids)}))
            batch[f"{prefix}spans"], batch[f"{prefix}item_ids"], batch[f"{prefix}n_words"] = spans, found, words
            yield batch

    return scan


def find_contamination(docs: DataFrame, items: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with n_words, spans (merged hits by word number and by code point of the original, end exclusive), item_ids, n_hit.

    The new names begin with ``prefix``; columns of these names are replaced.
    """
    spark = docs.sparkSession
    windows = item_windows(items)
    total = windows.agg(F.sum(F.length("pattern") + 8 * F.size("item_ids")).alias("chars")).first()["chars"] or 0
    blocks = max(1, -(-total // BLOCK_CHARS))
    empty = "array<struct<first_word:int,last_word:int,start:int,end:int>>"
    out = docs.withColumns({
        f"{prefix}n_words": F.lit(0).cast("long"), f"{prefix}spans": F.array().cast(empty), f"{prefix}item_ids": F.array().cast("array<string>"),
    })
    if blocks > 1:
        windows = cut_lineage(windows.withColumn("block", F.pmod(F.xxhash64("pattern"), F.lit(blocks))))
    for block in range(blocks):
        own = windows.where(F.col("block") == block) if blocks > 1 else windows
        patterns = [(row["pattern"], row["item_ids"]) for row in own.select("pattern", "item_ids").collect()]
        out = out.mapInPandas(_scanner(spark.sparkContext.broadcast(patterns), text, prefix), out.schema)
        if block + 1 < blocks:
            out = cut_lineage(out)
    hit = F.aggregate(f"{prefix}spans", F.lit(0).cast("long"), lambda sum_, span: sum_ + span["last_word"] - span["first_word"] + 1)
    return out.withColumn(f"{prefix}n_hit", hit)


def items_digest(item_ids: str = "item_ids") -> Column:
    return F.sha2(F.array_join(F.array_sort(item_ids), ","), 256)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        items_digest().alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+'), lambda w: w <> '') AS words
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS width, array_to_string(words[s:s + 9], ' ') AS pattern
  FROM item_words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS u(s) WHERE len(words) > 0),
doc_words AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(list_filter(regexp_split_to_array(
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+'),
         lambda w: w <> ''), []) AS words
  FROM documents),
grams AS (
  SELECT rid, s, width, array_to_string(words[s:s + width - 1], ' ') AS pattern
  FROM doc_words, (SELECT DISTINCT width FROM windows) AS w, unnest(range(1, len(words) - width + 2)) AS u(s)),
hits AS (SELECT rid, s, width, item_id FROM grams JOIN windows USING (width, pattern)),
hit_words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT rid, s, width FROM hits) AS h, unnest(range(s, s + width)) AS u(p) GROUP BY rid),
hit_items AS (
  SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)
"""
