"""Language identification: multinomial naive Bayes over hashed character n-grams.

The n-gram counts of every training text are summed by Spark per language and bucket, so the model is at most
``buckets`` x languages numbers whatever the size of the corpus.  It is broadcast in blocks of ``LANGUAGE_BLOCK``
languages (16 MB each): texts meet one block after the other and carry the best language so far along.

Defined results: a text that is null or has no letter gets ``und`` and score 0; ties between languages go to the smaller name;
without training rows every text is ``und``.  Repeated rows count and are scored once each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homelake.llm.common import held_out, table
from homelake.session import cut_lineage

BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
LANGUAGE_BLOCK = 128
SMOOTHING = 0.5
_CHUNK_CHARS = 1 << 18
_LETTER = re.compile(r"[^\W\d_]")
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def ngram_buckets(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of all character n-grams of a lower-cased text, in chunks of bounded size."""
    text = f" {text.lower()} "
    overlap = max(ORDERS) - 1
    for start in range(0, max(1, len(text) - overlap), _CHUNK_CHARS):
        last = start + _CHUNK_CHARS >= len(text) - overlap
        piece = text[start : None if last else start + _CHUNK_CHARS + overlap]
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        starts = len(codes) if last else _CHUNK_CHARS
        for order in ORDERS:
            mixed = np.full(min(starts, max(0, len(codes) - order + 1)), order * 0x27D4EB2F & 0xFFFFFFFF, dtype=np.uint32)
            for i in range(order):
                mixed += codes[i : i + len(mixed)] * _MULTIPLIERS[i]
                mixed ^= mixed >> np.uint32(15)
                mixed *= np.uint32(0x2C1B3C6D)
            yield (mixed >> np.uint32(18)).astype(np.int32)


def ngram_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bucket, n) over all rows with a text and a language; bucket -1 counts the texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}

        def rows() -> pd.DataFrame:
            parts = []
            for name, sum_ in sums.items():
                used = np.flatnonzero(sum_)
                parts.append(pd.DataFrame({"lang": name, "bucket": used.astype(np.int32) - 1, "n": sum_[used]}))
            sums.clear()
            return pd.concat(parts, ignore_index=True)

        for batch in batches:
            for content, name in zip(batch[text], batch[lang]):
                own = sums.setdefault(name, np.zeros(BUCKETS + 1, dtype=np.int64))
                own[0] += 1
                for found in ngram_buckets(content):
                    own[1:] += np.bincount(found, minlength=BUCKETS)
                if len(sums) > LANGUAGE_BLOCK:
                    yield rows()
        if sums:
            yield rows()

    known = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text), F.col(lang))
    return known.mapInPandas(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def _log_model(spark: SparkSession, counts: DataFrame, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities by bucket and language, and the languages' numbers of texts."""
    sums = np.zeros((BUCKETS + 1, len(names)))
    place = {name: i for i, name in enumerate(names)}
    rows = counts.where(F.col("lang").isin(names)).toPandas()
    np.add.at(sums, (rows["bucket"].to_numpy() + 1, rows["lang"].map(place).to_numpy()), rows["n"].to_numpy())
    smooth = sums[1:] + SMOOTHING
    return np.log(smooth / smooth.sum(axis=0)), sums[0]


def predict_language(docs: DataFrame, counts: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (posterior probability); ``counts`` as from :func:`ngram_counts`, stored."""
    spark = docs.sparkSession
    texts = counts.where("bucket = -1").orderBy("lang").collect()  # a row for each language
    total = sum(row["n"] for row in texts)
    out = docs.withColumns({
        "__best": F.lit(None).cast("string"), "__high": F.lit(None).cast("double"), "__all": F.lit(None).cast("double"),
    })
    for start in range(0, len(texts), LANGUAGE_BLOCK):
        names = [row["lang"] for row in texts[start : start + LANGUAGE_BLOCK]]
        logs, own = _log_model(spark, counts, names)
        model = spark.sparkContext.broadcast((names, logs, np.log(own / total)))
        out = out.mapInPandas(_scorer(model, text), out.schema)
    posterior = F.exp(F.col("__high") - F.col("__all"))
    return out.withColumns({
        "lang_pred": F.coalesce(F.col("__best"), F.lit("und")),
        "score": F.when(F.col("__best").isNotNull(), F.least(posterior, F.lit(1.0))).otherwise(0.0),
    }).drop("__best", "__high", "__all")


def _scorer(model, text: str):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, logs, priors = model.value
        for batch in batches:
            best, high, every = list(batch["__best"]), batch["__high"].to_numpy(float).copy(), batch["__all"].to_numpy(float).copy()
            for i, content in enumerate(batch[text]):
                if content is None or not _LETTER.search(content):
                    continue
                sums = priors.copy()
                for found in ngram_buckets(content):
                    for at in range(0, len(found), _CHUNK_CHARS // len(names) + 1):
                        sums += logs[found[at : at + _CHUNK_CHARS // len(names) + 1]].sum(axis=0)
                top = int(sums.argmax())
                mass = float(np.logaddexp.reduce(sums))
                every[i] = mass if np.isnan(every[i]) else np.logaddexp(every[i], mass)
                if np.isnan(high[i]) or sums[top] > high[i]:
                    best[i], high[i] = names[top], sums[top]
            batch["__best"], batch["__high"], batch["__all"] = pd.Series(best, index=batch.index, dtype=object), high, every
            yield batch

    return score


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = cut_lineage(ngram_counts(docs.where(~held_out())))
    slim = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict_language(slim, counts).select("doc_id", "held_out", "lang_pred", "score")
