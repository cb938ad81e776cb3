"""Key tables: no exchange of the history, pruned buckets and row groups, compaction, broken-off steps."""

import os
import re

import pytest
from pyspark.sql import functions as F

from homelake.operators import new_rows
from homelake.sources import add_keys, add_seen, append_run, compact_keys, known_keys, seen_ids, stored_keys
from homelake.sources import keys as module


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id string")


def listed(df):
    return sorted(r["id"] for r in df.collect())


def metric(df, node, name):
    """Sum of a metric over the executed nodes of a kind."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        plan = todo.pop()
        if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(plan.executedPlan())
            continue
        if "QueryStageExec" in plan.getClass().getSimpleName():
            todo.append(plan.plan())
        if plan.nodeName().startswith(node) and plan.metrics().contains(name):
            total += plan.metrics().apply(name).value()
        todo += [plan.children().apply(i) for i in range(plan.children().size())]
    return total


def test_keys_come_back_in_another_session_and_from_other_writers(spark, tmp_path):
    folder = str(tmp_path / "it's")
    add_keys(ids(spark, "a", "b", None, "a"), folder, "id", buckets=4)
    add_keys(ids(spark, "b", "c"), folder, "id")  # the number of buckets stays
    assert listed(stored_keys(spark, folder, "id").distinct()) == ["a", "b", "c"]
    assert [name for name in os.listdir(folder)] == ["hashed_4"]
    other = spark.newSession()
    add_keys(ids(other, "d"), folder, "id")
    assert listed(stored_keys(spark, folder, "id").distinct()) == ["a", "b", "c", "d"]
    assert listed(known_keys(spark, folder, "id", ids(spark, "d", "x", "a"))) == ["a", "d"]
    assert stored_keys(spark, str(tmp_path / "none"), "id").count() == 0


@pytest.mark.parametrize("shuffles", [True, False])
def test_the_history_is_not_shuffled(spark, tmp_path, shuffles):
    folder = str(tmp_path / "seen")
    add_keys(spark.range(20_000).select(F.col("id").cast("string")), folder, "id", buckets=4)
    batch = spark.range(0, 60_000, 3).select(F.col("id").cast("string"), F.lit(1).alias("at"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1" if shuffles else before)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "4")  # no more than buckets
    try:
        fresh = new_rows(batch, stored_keys(spark, folder, "id"), "id", ["at"], long_history=True)
        assert fresh.count() == 20_000 - 6_667
        plan = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    lines = plan.splitlines()
    scan = next(at for at, line in enumerate(lines) if "FileScan parquet" in line and ".keys_" in line)
    assert not shuffles or "Bucketed: true" in lines[scan]
    depth = len(re.match(r"[ :+\-]*", lines[scan])[0])
    for line in reversed(lines[:scan]):  # the nodes above the scan, up to the first join
        own = len(re.match(r"[ :+\-]*", line)[0])
        if own < depth:
            depth = own
            assert "Exchange" not in line, plan
            if "Join" in line:
                break
    else:
        raise AssertionError(plan)


def test_few_keys_read_only_their_buckets_and_row_groups(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "seen")
    # Two files per bucket whose ranges overlap, so only Bloom filters tell them apart.
    for part in (0, 1):
        add_keys(spark.range(part, 40_000, 2).select(F.sha2(F.col("id").cast("string"), 256).alias("id")), folder, "id", buckets=8)
    asked = spark.range(4, 7, 2).select(F.sha2(F.col("id").cast("string"), 256).alias("id"))  # both of the first part
    known = known_keys(spark, folder, "id", asked)
    assert known.count() == 2
    assert "SelectedBucketsCount: 2 out of 8" in known._jdf.queryExecution().executedPlan().toString()
    # One row group per file: those of the second part are ruled out by their Bloom filters.
    rows = metric(known, "Scan parquet", "numOutputRows")
    assert 0 < rows <= 2 * 20_000 / 8 * 1.2, rows
    monkeypatch.setattr(module, "PUSHED_KEYS", 1)
    assert listed(known_keys(spark, folder, "id", asked)) == listed(asked)


def test_crowded_buckets_are_merged_for_themselves(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "seen")
    monkeypatch.setattr(module, "MOST_FILES", 10**9)
    add_keys(spark.range(100).select(F.col("id").cast("string")), folder, "id", buckets=4)
    one = stored_keys(spark, folder, "id").where("id = '7'")
    for _ in range(5):
        add_keys(ids(spark, "7"), folder, "id")
    files = set(os.listdir(f"{folder}/hashed_4"))
    assert one.count() == 1 and stored_keys(spark, folder, "id").count() == 105
    assert compact_keys(spark, folder, "id", most_files=3) == 1
    after = {name for name in os.listdir(f"{folder}/hashed_4")}
    assert len([name for name in files & after if name.endswith(".parquet")]) == 3  # three buckets are as they were
    assert os.listdir(folder) == ["hashed_4"]
    assert listed(stored_keys(spark, folder, "id")) == sorted(str(i) for i in range(100))
    assert compact_keys(spark, folder, "id", most_files=3) == 0


def test_a_run_whose_ids_were_not_all_written_is_noted_again(spark, tmp_path):
    bronze = str(tmp_path)
    append_run(spark.createDataFrame([('{"id":"a"}',), ('{"id":"b"}',), ('{"x":1}',)], "record string"), bronze, "properties", "1")
    add_keys(ids(spark, "a"), f"{bronze}/seen_ids/properties", "id")  # broke off before "b" and before the run was marked
    assert listed(seen_ids(spark, bronze, "properties", "id")) == ["a", "b"]
    assert os.listdir(f"{bronze}/seen_ids/properties/runs") and listed(seen_ids(spark, bronze, "properties", "id")) == ["a", "b"]
    add_seen(ids(spark, "c"), bronze, "properties", "id", "2")
    add_seen(ids(spark, "c"), bronze, "properties", "id", "2")
    assert listed(seen_ids(spark, bronze, "properties", "id")) == ["a", "b", "c"]
