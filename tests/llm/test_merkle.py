"""The Merkle manifest against a plain version of its contract, with awkward rows."""

import zlib

import pytest
from pyspark.sql import functions as F

from homelake.llm import merkle
from homelake.llm.merkle import build_manifest, climb, leaf_digest, op11_merkle
from tests.llm.helpers import DOCS, digest, write_tables


def runs(nodes):
    return [nodes[i : i + 2] for i in range(0, len(nodes), 2)]


def path(nodes, at):
    """Top digest of the nodes and, level by level, (siblings before, siblings after) of the node ``at``."""
    steps = []
    while len(nodes) > 1:
        own = runs(nodes)[at // 2]
        steps.append(([own[0]] if at % 2 else [], own[1:] if at % 2 == 0 else []))
        nodes, at = [digest("".join(run)) for run in runs(nodes)], at // 2
    return nodes[0], steps


def fold(h, steps):
    for before, after in steps:
        h = digest("".join([*before, h, *after]))
    return h


def expected(rows):
    def leaf(row, more=0):
        doc_id, text, lang, source, n_chars = row
        values = [doc_id, source, lang, n_chars + more if n_chars is not None else None, text]
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = [sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for lang in langs]
    subroots = [path([leaf(r) for r in tree], 0)[0] for tree in trees]
    out = []
    for number, tree in enumerate(trees):
        for at, row in enumerate(tree):
            subroot, low = path([leaf(r) for r in tree], at)
            root, high = path(subroots, number)
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            folded = fold(leaf(row, int(tampered)), low + high)
            proof = digest("".join(s for before, after in low + high for s in before + after))
            out.append((row[0], leaf(row), subroot, root, proof, folded, folded == root))
    return sorted(map(repr, out))


@pytest.mark.parametrize("depth", [8, 2])
def test_rows_of_every_shape(spark, tmp_path, monkeypatch, depth):
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "FAN", 1 << depth)
    rows = [(i, f"text {i} é", "de", "s", 5) for i in range(600)] + [(i, None, "en", None, None) for i in range(600, 617)]
    rows += [(7, "same id", "de", "s", 1), (7, "same id", "de", "s", 1), (None, "no id", "de", "s", 2), (-3, "", None, "", 0), (9001, "x" * 50_000, "ü", "s", 3)]
    rows += [(10**18 + i, "far", f"l{i}", "s", 2**63 - 1) for i in range(20)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("tree", F.lit("x")).withColumn("page", F.lit(1))
    found = op11_merkle(spark, write_tables(spark, tmp_path, documents=docs)).collect()
    assert sorted(repr(tuple(r)) for r in found) == expected(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 256, 257])
def test_small_tables(spark, tmp_path, n):
    rows = [(i, f"{i}", "en", "s", i) for i in range(n)]
    found = op11_merkle(spark, write_tables(spark, tmp_path, documents=spark.createDataFrame(rows, DOCS))).collect()
    assert sorted(repr(tuple(r)) for r in found) == (expected(rows) if n else [])


def test_siblings_are_returned(spark):
    rows = spark.createDataFrame([("a", i) for i in range(3)], "g string, i long").withColumn("leaf", leaf_digest(F.col("i")))
    found = {r["id"]: [bytes(s).hex() for s in r["siblings"]] for r in climb(*build_manifest(rows, "g", "i")).collect()}
    leaf = [digest(f"1:{i}") for i in range(3)]
    assert found == {0: [leaf[1], digest(leaf[2])], 1: [leaf[0], digest(leaf[2])], 2: [digest(leaf[0] + leaf[1])]}
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") != "-1"
