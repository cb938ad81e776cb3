import random

from homelake.llm.near_dedup import components, near_duplicates, op9_near_dedup
from tests.llm.helpers import dedup_components, documents, shingle_set, write_tables


def words(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)]


def changed(base, seed, times):
    rng, out = random.Random(seed), list(base)
    for _ in range(times):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return out


def compare(spark, rows, percent=85):
    found = near_duplicates(documents(spark, rows).select("doc_id", "text"), percent=percent).collect()
    expected = sorted((doc_id, len(shingle_set(text)), c, doc_id == c) for (doc_id, text), c in zip(rows, dedup_components(rows, percent)))
    assert sorted(tuple(row) for row in found) == expected


def test_near_copies_chains_and_common_passages(spark):
    base, passage = words(1, 150), words(2, 40)
    rows = [(i, " ".join(changed(base, i, i % 7))) for i in range(60)]
    rows += [(100 + i, " ".join(passage + words(200 + i, 12))) for i in range(30)]
    chain = words(3, 120)
    for i in range(8):
        chain = chain[3:] + words(300 + i, 3)
        rows.append((200 + i, " ".join(chain)))
    rows += [(300 + i, " ".join(words(4, 50))) for i in range(5)] + [(400, "One two"), (401, "one TWO"), (402, "one two three")]
    random.Random(0).shuffle(rows)
    compare(spark, rows)
    compare(spark, rows, percent=80)


def test_long_sets_use_sampled_sketches(spark):
    base = words(5, 3000)
    compare(spark, [(i, " ".join(changed(base, i, 40 * i))) for i in range(6)] + [(10, " ".join(words(6, 3000)))])


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b c d e f"), (4, "a b c d e f"), (5, "A B C D E F"), (None, "a b c d e f"), (6, "É b c d e"), (7, "é b c d e")]
    found = near_duplicates(documents(spark, rows).select("text", "doc_id")).collect()
    assert sorted(map(tuple, found), key=repr) == sorted([
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 2, 4, True), (4, 2, 4, True), (5, 2, 4, False), (None, 2, None, True),
        (6, 1, 6, True), (7, 1, 7, True)], key=repr)


def test_empty_table_and_extra_columns(spark, tmp_path):
    assert near_duplicates(documents(spark, []).select("doc_id", "text")).collect() == []
    from pyspark.sql import functions as F

    odd = documents(spark, [(1, "a b c d e")]).withColumns({"set_key": F.lit(1), "kept": F.lit("x"), "value": F.lit(2)})
    folder = write_tables(spark, tmp_path, documents=odd)
    assert [tuple(row) for row in op9_near_dedup(spark, folder).collect()] == [(1, 1, 1, True)]


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(200, 201), (201, 200)]
    found = {row["node"]: row["root"] for row in components(spark.createDataFrame(links, "a_key int, b_key int")).collect()}
    assert found == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(20)}, 200: 200, 201: 200}


def test_a_whole_set_meets_a_partner_that_is_cut_to_the_sketch(spark):
    for size, longer, percent in ((32, 37, 85), (32, 39, 80), (32, 40, 80)):
        rows = []
        for seed in range(60):
            text = words(f"{size} {longer} {seed}", longer + 4)
            rows += [(2 * seed, " ".join(text[: size + 4])), (2 * seed + 1, " ".join(text))]
        found = {row["doc_id"]: row for row in near_duplicates(documents(spark, rows).select("doc_id", "text"), percent=percent).collect()}
        assert {found[i]["n_shingles"] for i in found} == {size, longer}
        assert [i for i in range(60) if found[2 * i + 1]["component_id"] != 2 * i] == []
