"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic texts and unlabelled texts train a linear classifier in numpy.  Its risk is that of Kiryo et al. 2017:
prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)); where the second term turns negative, the step goes
the other way.  The class prior is the toxic share of the labelled training rows.  A text's features are its distinct words and word stems,
hashed; only features that positives hold significantly more often take part.  A fourth of the sample is kept from training and sets slope and
offset of the score under the same risk.

Fitting uses a bounded sample, the smallest hashes of the ids: at most ``POSITIVES`` confirmed and about ``UNLABELLED`` other texts.  Counts
for the prior and the scores cover all rows.  Defined results: a null text scores like an empty one; labels without id or value are left out, of
contradicting labels the toxic one holds; without a confirmed toxic text every score is the prior (0 without any label).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homelake.llm.common import drawn, held_out, table

POSITIVES = 4_000
UNLABELLED = 12_000
THRESHOLD = 0.7
FEATURES = 1 << 20
MIN_Z = 4.0
_WORD = re.compile(r"[^\W\d_]+")
_CACHED_WORDS = 500_000


class ToxicityModel(NamedTuple):
    features: np.ndarray  # hashes taking part, ascending
    weights: np.ndarray
    bias: float
    slope: float
    offset: float


def _word_features(word: str) -> tuple[int, ...]:
    """The word itself and its stems of four and five letters."""
    names = [f"w{word}", *(f"{n}{word[:n]}" for n in (4, 5) if len(word) > n)]
    return tuple(zlib.crc32(name.encode()) % FEATURES for name in names)


class _Words(dict):
    """Features of each word, looked up once; holds a bounded number of words."""

    def __init__(self, kept: frozenset[int] | None = None) -> None:
        super().__init__()
        self.kept = kept

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        found = _word_features(word)
        self[word] = found if self.kept is None else tuple(x for x in found if x in self.kept)
        return self[word]

    def of(self, text: str | None) -> np.ndarray:
        found: set[int] = set()
        for word in set(_WORD.findall(text.lower())) if text else ():
            found.update(self[word])
        return np.array(sorted(found), dtype=np.int32)


def _featured(docs: DataFrame, text: str) -> DataFrame:
    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _Words()
        for batch in batches:
            batch["features"] = [words.of(value).tobytes() for value in batch.pop("text")]
            yield batch

    return docs.select("doc_id", F.col(text).alias("text")).mapInPandas(features, "doc_id long, features binary")


def _risk_terms(scores: np.ndarray, positives: int) -> tuple[float, float, float]:
    """Mean logistic losses: positives as toxic, positives as clean, unlabelled as clean."""
    return (
        float(np.logaddexp(0, -scores[:positives]).mean()),
        float(np.logaddexp(0, scores[:positives]).mean()),
        float(np.logaddexp(0, scores[positives:]).mean()),
    )


def train_nnpu(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], size: int, prior: float, epochs: int = 20, rate: float = 0.1, decay: float = 1e-4
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier over sparse binary features, by mini-batch AdaGrad on the non-negative risk."""
    random = np.random.default_rng(0)
    weights, squares = np.zeros(size), np.full(size, 1e-8)
    bias, bias_square = float(np.log(prior / (1 - prior))), 1e-8
    batch = 500
    for _ in range(epochs):
        order = random.permutation(len(unlabelled))
        for start in range(0, len(order), batch):
            own = [unlabelled[i] for i in order[start : start + batch]]
            known = [positive[i] for i in random.integers(0, len(positive), min(batch, len(positive)))]
            rows = known + own
            columns = np.concatenate(rows)
            at = np.repeat(np.arange(len(rows)), [len(row) for row in rows])
            scores = np.bincount(at, weights=weights[columns], minlength=len(rows)) + bias
            chance = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
            n = len(known)
            _, clean_positive, clean_unlabelled = _risk_terms(scores, n)
            slope = np.empty(len(rows))
            if clean_unlabelled >= prior * clean_positive:
                slope[:n] = -prior / n
                slope[n:] = chance[n:] / len(own)
            else:
                slope[:n] = prior * chance[:n] / n
                slope[n:] = -chance[n:] / len(own)
            step = np.bincount(columns, weights=slope[at], minlength=size)
            used = np.flatnonzero(step)
            step = step[used] + decay * weights[used]
            squares[used] += step**2
            weights[used] -= rate * step / np.sqrt(squares[used])
            bias_square += slope.sum() ** 2
            bias -= rate * slope.sum() / np.sqrt(bias_square)
    return weights, bias


def _calibrate(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and offset of least non-negative risk over held-back scores."""
    every = np.unique(np.concatenate([positive, unlabelled]))
    cuts = np.unique(np.quantile((every[1:] + every[:-1]) / 2, np.linspace(0, 1, 400))) if len(every) > 1 else every
    best = (np.inf, 1.0, 0.0)
    for slope in (1.0, 2.0, 4.0, 8.0, 16.0):
        for cut in cuts:
            toxic, clean_positive, clean_unlabelled = _risk_terms(slope * (np.concatenate([positive, unlabelled]) - cut), len(positive))
            risk = prior * toxic + max(0.0, clean_unlabelled - prior * clean_positive)
            best = min(best, (risk, slope, -slope * float(cut)))
    return best[1], best[2]


def fit_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text") -> ToxicityModel:
    """Model from documents (doc_id, text) and labels (doc_id, toxic) that may be learned from."""
    labelled = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") == 1).alias("toxic"))
    counts = labelled.agg(F.count("*").alias("n"), F.count_if("toxic").alias("toxic")).first()
    known = docs.where("doc_id is not null")
    rows = known.count()
    prior = counts["toxic"] / counts["n"] if counts["n"] else 0.0
    nothing = ToxicityModel(np.array([], np.int32), np.array([]), float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))), 1.0, 0.0)
    if not counts["toxic"] or not rows or prior == 1.0:
        return nothing
    confirmed = labelled.where("toxic").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(POSITIVES)
    # A share in millionths, rounded up, and of these what makes it exact: about UNLABELLED rows at any size.
    millionths = int(np.ceil(min(1.0, UNLABELLED / rows) * 1_000_000))
    coarse = F.pmod(F.xxhash64("doc_id", F.lit("unlabelled")), F.lit(1_000_000)) < millionths
    others = known.where(coarse & drawn(F.col("doc_id"), UNLABELLED, rows * millionths // 1_000_000))
    sample = (
        _featured(known.join(F.broadcast(confirmed), "doc_id"), text).withColumn("positive", F.lit(True))
        .unionByName(_featured(others, text).withColumn("positive", F.lit(False)))
        .dropDuplicates(["doc_id", "positive"])
        .toPandas().sort_values(["positive", "doc_id"], ignore_index=True)
    )
    kept_back = np.array([zlib.crc32(f"{x} split".encode()) % 4 == 0 for x in sample["doc_id"]])
    groups = [[], [], [], []]  # positives and unlabelled to train from, then those kept back
    for features, positive, back in zip(sample["features"], sample["positive"], kept_back):
        groups[2 * back + (not positive)].append(np.frombuffer(features, dtype=np.int32))
    positive, unlabelled, back_positive, back_unlabelled = groups
    if not positive or not unlabelled:
        return nothing
    in_positive = np.bincount(np.concatenate(positive), minlength=FEATURES)
    in_unlabelled = np.bincount(np.concatenate(unlabelled), minlength=FEATURES)
    pooled = (in_positive + in_unlabelled) / (len(positive) + len(unlabelled))
    spread = np.sqrt(pooled * (1 - pooled) * (1 / len(positive) + 1 / len(unlabelled)))
    gap = in_positive / len(positive) - in_unlabelled / len(unlabelled)
    features = np.flatnonzero((gap > MIN_Z * spread) & (in_positive >= 2)).astype(np.int32)

    def narrowed(rows: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(features, row[np.isin(row, features, assume_unique=True)]) for row in rows]

    if not len(features):
        return nothing
    weights, bias = train_nnpu(narrowed(positive), narrowed(unlabelled), len(features), prior)
    if not back_positive or not back_unlabelled:
        return ToxicityModel(features, weights, bias, 1.0, 0.0)
    scores = [np.array([weights[row].sum() + bias for row in narrowed(rows)]) for rows in (back_positive, back_unlabelled)]
    return ToxicityModel(features, weights, bias, *_calibrate(*scores, prior))


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score", predicted: str = "predicted"
) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``THRESHOLD`` on); columns of these names are replaced."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tuple(model))  # at most FEATURES numbers
    scored = docs.drop(predicted).withColumn(score, F.lit(0.0))

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features, weights, bias, slope, offset = shared.value
        place = dict(zip(features.tolist(), weights.tolist()))
        words = _Words(frozenset(place))
        for batch in batches:
            raw = np.array([sum(place[x] for x in words.of(value).tolist()) for value in batch[text]]) + bias
            batch[score] = 1 / (1 + np.exp(-np.clip(slope * raw + offset, -30, 30)))
            yield batch

    return scored.mapInPandas(add, scored.schema).withColumn(predicted, (F.col(score) >= THRESHOLD).cast("int"))


def fit_on_training_folds(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    return fit_toxicity(docs.where(~held_out()), labels.where(~held_out()))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_on_training_folds(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", "predicted")
