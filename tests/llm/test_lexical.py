"""Ranked lexical search against a plain version of its contract."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from homelake.llm import lexical
from homelake.llm.lexical import _Bucket, op12_lexical
from tests.llm.helpers import documents, write_tables

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))


def ranked(docs, items):
    counts = [(i, Counter(terms(text))) for i, text in docs if terms(text)]
    total, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked, out = {}, []
    for item_id, text in items:
        if item_id is not None:
            asked.setdefault(item_id, set()).update(terms(text))
    for item_id, wanted in asked.items():
        scores = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * total // length
            weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) for t in wanted if t in c}
            score = sum(w * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, w in weight.items())
            if score > 0 and i is not None:
                scores.append((-score, i))
        out += [(item_id, rank + 1, i, -score) for rank, (score, i) in enumerate(sorted(scores)[:10])]
    return sorted(out)


@pytest.mark.parametrize("block, seeds, bucket", [(500_000, 2048, 4096), (40, 7, 16), (500_000, 1, 3)])
def test_scores_and_ranks(spark, tmp_path, monkeypatch, block, seeds, bucket):
    for name, value in (("BLOCK_TERMS", block), ("SEED_ROWS", seeds), ("BUCKET_ROWS", bucket)):
        monkeypatch.setattr(lexical, name, value)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["Äpfel", "日本", "É", "é", "7"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(rng.choices(words, weights, k=rng.choice([1, 3, 8, 40]))) for _ in range(300)]
    texts += [None, "", " .,-", "W1-w2_W3", texts[5], texts[5], "w1 " * 30_000 + "w44", "only here"] + [texts[9]] * 40
    docs = [*enumerate(texts), (4, texts[4]), (4, "w1 w2 w50"), (None, "w1 w2 w3 w50"), (-5, texts[9])]
    items = [(1, "w1 W2 w3"), (2, "w50 w51 É 日本"), (3, None), (4, "..."), (5, "unknown"), (6, " ".join(words)), (6, "w59"), (None, "w1"), (7, "w44 w44 here")]
    folder = write_tables(spark, tmp_path, documents=documents(spark, docs).withColumn("terms", F.lit("x")),
                          benchmark=spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, op12_lexical(spark, folder).collect())) == ranked(docs, items)


def test_empty_tables(spark, tmp_path):
    item = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for docs, items in ((documents(spark, []), item), (documents(spark, [(1, "")]), item), (documents(spark, [(1, "a"), (2, "b")]), item.where("false"))):
        folder = write_tables(spark, tmp_path, documents=docs, benchmark=items)
        assert op12_lexical(spark, folder).collect() == []


def test_bounds_drop_rows_but_no_result():
    import numpy as np
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(50, size=rng.integers(1, 20), replace=False)) for _ in range(200)]
    impacts = [rng.integers(1, 10**9, size=len(row)) for row in rows]
    norms = np.array([np.sqrt((own.astype(float) ** 2).sum()) for own in impacts])
    bucket, item = _Bucket(np.arange(200), norms, rows, impacts), np.array([3, 7, 20, 48, 49])
    full = np.array([own[np.isin(row, item)].sum() for row, own in zip(rows, impacts)])
    for bound in (1, int(np.sort(full)[-10]), int(full.max()), int(full.max()) + 1):
        found, scores = bucket.found(item, bound)
        assert sorted(zip(found, scores)) == [(i, s) for i, s in enumerate(full) if s >= bound]
