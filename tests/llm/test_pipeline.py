"""The corpus pipeline, stage by stage, on planted documents."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from homelake.session import cut_lineage
from tests.llm.helpers import documents, write_tables


def prose(seed, n=60):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) for _ in range(n)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, labels = [], []
    for i in range(300):
        words = prose(i)
        if i % 6 == 0:
            words[5:5] = ["zorq", "vexil"]
            words.append("krump")
        rows.append((i, " ".join(words), f"s{i % 4}"))
        labels.append((i, 1, int(i % 6 == 0)))
    item = " ".join(prose("item", 30))
    rows += [(1000, rows[1][1], "s0"), (1001, rows[1][1] + " extra", "s0"), (1002, " ".join(prose("leak")) + " " + item, "s1"),
             (1003, " ".join(prose("mail")) + " jane.doe@mail.example.com", "s2"), (1004, None, "s3"), (1005, "", None), (2, rows[2][1], "s2"), (None, "no id", "s1")]
    docs = documents(spark, rows).withColumns({"spans": F.lit("x"), "taken": F.lit(1), "score": F.lit(2.0), "kept": F.lit(3), "email": F.lit(4)})
    tables = {"documents": docs, "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
              "benchmark": spark.createDataFrame([(1, item)], "item_id long, text string")}
    return write_tables(spark, tmp_path_factory.mktemp("corpus"), **tables)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, folder))
        seen.append((name, {r["doc_id"]: r for r in docs.collect()}, docs.columns, docs.count()))
    assert [names for _, _, names, _ in seen[:-1]] == [columns] * 4
    toxic, near, clean, private, mixed = [rows for _, rows, _, _ in seen]
    assert not [i for i in toxic if i is not None and i < 300 and i % 6 == 0] and len(toxic) == 250 + 7
    assert set(toxic) - set(near) == {1000, 1001} and seen[1][3] == len(near)
    assert set(near) - set(clean) == {1002} and set(private) == set(clean)
    assert private[1003]["text"].endswith(" [EMAIL]") and private[1003]["n_chars"] == len(private[1003]["text"])
    assert private[1004]["text"] is None and {"size", "target", "taken"} <= set(seen[4][2])
    assert set(mixed) <= set(private) and all(r["taken"] > 0 for r in mixed.values())
    assert sum(r["taken"] for r in mixed.values()) == pytest.approx(sum(len((r["text"] or "").split()) for r in private.values()), abs=5)


def test_run_gives_the_last_stage(spark, folder):
    rows = [r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()]
    assert len(rows) == len(set(rows)) > 150 and not {1000, 1001, 1002} & set(rows)


def plain_chain(rows, toxic, items):
    """Kept (doc_id, text) before the mix by comparing everything with everything, given the rows that are toxic."""
    from tests.llm.helpers import base_pii, shingle_set

    rows = [row for row in rows if row not in toxic]
    sets = [shingle_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] & sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(top(i), []).append((doc_id is None, doc_id or 0, i))
    rows = [rows[min(members)[2]] for members in groups.values()]
    windows = {tuple(words[i : i + 10]) for words in map(str.split, items) for i in range(max(1, len(words) - 9))}
    rows = [(i, t) for i, t in rows if not any(tuple((t or "").split()[a : a + 10]) in windows for a in range(len((t or "").split())))]
    out = []
    for doc_id, text in rows:
        for span in reversed([s for s in base_pii(text).split(",") if s]):
            kind, start, end = span.split(":")
            text = text[: int(start)] + f"[{kind.upper()}]" + text[int(end) :]
        out.append((doc_id, text))
    return sorted(out, key=repr)


def test_the_chain_matches_its_plain_version(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    item = " ".join(prose("item", 30))
    # Unlike texts under one id, and copies of each other under several.
    more = documents(spark, [(5, " ".join(prose("five")), "s0"), (7, " ".join(prose("five")), "s1"), (None, " ".join(prose("five")), "s1"), (9, "", "s2")])
    docs = cut_lineage(docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(more))
    every = [(r["doc_id"], r["text"]) for r in docs.collect()]
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = cut_lineage(stage(spark, out, folder))
        if name == "toxicity":
            kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    toxic = {row for row in every if row not in kept}
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == plain_chain(every, toxic, [item])


def test_a_run_leaves_nothing_behind(spark, folder, tmp_path, monkeypatch):
    import os

    from homelake import session

    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    with session.work_tables(spark):
        rows = corpus_pipeline.run(spark, folder)
        assert rows.count() > 150 and os.listdir(tmp_path)
    assert os.listdir(tmp_path) == []


def test_empty_corpus(spark, folder, tmp_path):
    tables = {name: spark.read.parquet(f"{folder}/{name}.parquet").limit(0) for name in ("documents", "labels", "benchmark")}
    assert corpus_pipeline.run(spark, write_tables(spark, tmp_path, **tables)).collect() == []
