"""Operators with one key holding a third of all rows, against plain Python."""

import random
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from homelake import operators as op

N = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    rows = []
    for i in range(N):
        draw = rng.random()
        key = "hot" if draw < 0.34 else None if draw < 0.5 else f"k{rng.randrange(40)}"
        rows.append((i, key, round(rng.uniform(0, 1000), 2)))
    return rows, spark.createDataFrame(rows, "id int, key string, value double").repartition(6).cache()


@pytest.mark.parametrize("hot_rows", [1, 7, 100, 10**6])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join(spark, skewed, hot_rows, how):
    rows, fact = skewed
    dim = {"hot": 1, "k1": 2, "k2": 3, "unused": 4}
    dims = spark.createDataFrame(list(dim.items()), "key string, label int")
    found = sorted((r["id"], r["label"]) for r in op.lookup_join(fact, dims, "key", ["id"], how, hot_rows).collect())
    expected = [(i, dim.get(k)) for i, k, _ in rows if how == "left" or k in dim]
    assert found == sorted(expected)


def test_hot_and_missing_keys_are_spread(spark, skewed):
    _, fact = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        dims = spark.createDataFrame([("hot", 1)], "key string, label int")
        joined = op.lookup_join(fact, dims, "key", ["id"], hot_rows=50)
        sizes = Counter(r[0] for r in joined.select(F.spark_partition_id()).collect())
        assert len(sizes) == 4 and max(sizes.values()) < N / 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_group_std(spark, skewed, hot_rows):
    rows, fact = skewed
    groups = defaultdict(list)
    for _, key, value in rows:
        groups[key].append(value)
    for r in op.group_std(fact, "key", "value", "std", ["id"], hot_rows).collect():
        values = groups[r["key"]]
        expected = 0.0 if r["key"] is None or len(values) < 2 else statistics.stdev(values)
        assert r["std"] == pytest.approx(expected)


@pytest.mark.parametrize("accuracy, hot_rows", [(100_000, 10**6), (100_000, 0), (100, 0), (25, 5), (1000, 100)])
@pytest.mark.parametrize("digits", [2, -2])
def test_exact_median(spark, skewed, accuracy, hot_rows, digits):
    rows, fact = skewed
    groups = defaultdict(list)
    for _, key, value in rows:
        groups[key].append(round(value, digits))
    found = op.exact_median(
        fact, ["key"], F.round("value", digits), "m", {"n": F.count("id")}, hot_rows, accuracy).collect()
    assert {r["key"]: r["m"] for r in found} == pytest.approx({k: statistics.median(v) for k, v in groups.items()})
    assert {r["key"]: r["n"] for r in found} == {k: len(v) for k, v in groups.items()}


def test_exact_median_of_a_large_group(spark):
    values = spark.range(400_001).select(F.lit("g").alias("g"), F.col("id"), ((F.col("id") * 7919) % 400_009).alias("v"))
    expected = statistics.median([(i * 7919) % 400_009 for i in range(400_001)])
    for accuracy in (100, 10_000):
        assert op.exact_median(values, ["g"], F.col("v"), "m", hot_rows=1000, accuracy=accuracy).first()["m"] == expected


def test_first_and_latest_per_hot_key(spark, skewed):
    rows, fact = skewed
    latest = {}
    for i, key, value in rows:
        latest[key] = max(latest.get(key, (-1.0, -1)), (value, i))
    found = {r["key"]: (r["value"], r["id"]) for r in op.latest_per_key(fact, ["key"], ["value", "id"]).collect()}
    assert found == latest


def test_one_per_key_is_the_same_in_every_partitioning(spark, skewed):
    _, fact = skewed
    first = sorted(map(str, op.one_per_key(fact, ["key"]).collect()))
    assert sorted(map(str, op.one_per_key(fact.repartition(3, "value"), ["key"]).collect())) == first


def test_left_join_count_with_copies_on_both_sides(spark):
    base = spark.createDataFrame([("a", "x", 1.0)] * 3 + [("b", "y", 2.0), (None, "z", 3.0)], "id string, name string, m double")
    child = spark.createDataFrame([("a", 1), ("a", 2), ("a", None), (None, 5)], "id string, item int")
    found = op.left_join_count(base, child, "id", "item", ["id", "name"], ["m"], "n").collect()
    assert sorted((r["name"], r["n"], r["m"]) for r in found) == [("x", 6, 1.0), ("y", 0, 2.0), ("z", 0, 3.0)]


def test_monthly_means_with_a_hot_key(spark, skewed):
    from homelake.plans.gold import monthly_means

    rows, fact = skewed
    groups = spark.createDataFrame([("hot", "g"), ("k1", "g"), ("k2", "h")], "key string, g string")
    series = fact.withColumn("month", F.col("id") % 3)
    found = {(r["g"], r["month"]): r["mean"] for r in monthly_means(series, "key", ["month"], {"mean": "value"}, groups, ["g"]).collect()}
    expected = defaultdict(list)
    for i, key, value in rows:
        if key in ("hot", "k1", "k2"):
            expected["h" if key == "k2" else "g", i % 3].append(value)
    assert found == pytest.approx({k: statistics.mean(v) for k, v in expected.items()})


def test_heavy_keys_are_found_by_the_sketch(spark, skewed):
    from homelake.operators.joins import heavy_keys

    rows, fact = skewed
    counts = Counter(key for _, key, _ in rows)
    for hot_rows in (1, 20, 100, 900):
        found = {r[0]: r[1] for r in heavy_keys(fact, "key", hot_rows).collect()}
        assert set(found) == {key for key, n in counts.items() if n > hot_rows}
        assert all(parts == -(-counts[key] // hot_rows) for key, parts in found.items())
    assert heavy_keys(fact, "key", N).count() == 0
