"""Bucketed tables: upserts, and dashboards merged from states per bucket."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from homelake.operators import Measure, merge_states, partial_states
from homelake.plans import gold, silver, states
from homelake.sources import buckets, read_tables
from homelake.sources.readers import RUN_ID
from tests.listings import write_bronze

SCHEMA = "key string, at long, note string"


def rows_of(spark, folder):
    return {r["key"]: (r["at"], r["note"]) for r in buckets.read_buckets(spark, folder).collect()}


def upsert(spark, folder, rows):
    return buckets.upsert_latest(spark.createDataFrame(rows, SCHEMA), folder, ["key"], ["at", "note"], 4)


def test_upserts_equal_the_newest_of_all_runs(spark, tmp_path):
    rng, newest = random.Random(5), {}
    for run in range(4):
        rows = [(rng.choice([None, *map(str, range(30))]), rng.choice([None, *range(9)]), f"{run}-{i}") for i in range(25)]
        upsert(spark, str(tmp_path), rows)
        for key, at, note in rows:
            newest[key] = max(newest.get(key, (-2, "")), (-1 if at is None else at, note))
    assert rows_of(spark, str(tmp_path)) == {key: (None if at == -1 else at, note) for key, (at, note) in newest.items()}


def test_only_buckets_with_new_versions_are_rewritten(spark, tmp_path):
    folder = str(tmp_path)
    assert upsert(spark, folder, [(str(i), 5, "a") for i in range(40)]) == [0, 1, 2, 3]
    before = buckets.bucket_versions(spark, folder)
    assert upsert(spark, folder, [(str(i), 4, "older") for i in range(40)]) == []
    assert upsert(spark, folder, [(str(i), 5, "a") for i in range(40)]) == []
    touched = upsert(spark, folder, [("7", 6, "b"), ("8", 1, "older")])
    after = buckets.bucket_versions(spark, folder)
    assert len(touched) == 1 and {b for b in after if after[b] != before[b]} == set(touched)
    assert rows_of(spark, folder)["7"] == (6, "b") and len(rows_of(spark, folder)) == 40
    assert upsert(spark, folder, []) == []


def test_older_versions_go_with_the_next_write(spark, tmp_path):
    folder = str(tmp_path)
    for at in range(4):
        upsert(spark, folder, [("x", at, "n")])
    assert len(list(tmp_path.glob("buckets_4/table_version=*/table_bucket=*"))) == 2


def test_a_write_that_broke_off_is_completed_by_the_next(spark, tmp_path):
    folder = str(tmp_path)
    upsert(spark, folder, [(str(i), 1, "old") for i in range(20)])
    fresh = [(str(i), 2, "new") for i in range(20)]
    upsert(spark, folder, fresh)
    lost = min(buckets.bucket_versions(spark, folder))
    [path] = tmp_path.glob(f"buckets_4/table_version=2/table_bucket={lost}")
    buckets.remove_buckets(spark, str(path))  # as if it had not been put in place
    assert {at for at, _ in rows_of(spark, folder).values()} == {1, 2}
    assert upsert(spark, folder, fresh) == [lost]
    assert set(rows_of(spark, folder).values()) == {(2, "new")}


def test_a_bucket_may_become_empty(spark, tmp_path):
    folder = str(tmp_path)
    upsert(spark, folder, [(str(i), 1, "n") for i in range(20)])
    held = buckets.read_buckets(spark, folder)
    buckets.replace_buckets(held.where(F.col("table_bucket") != 2), folder, {2: 2, 3: 2})
    found = {r["table_bucket"]: r["table_version"] for r in buckets.read_buckets(spark, folder).collect()}
    assert found == {0: 1, 1: 1, 3: 2}


def test_states_of_parts_merge_to_the_aggregate(spark):
    rows = [(g, part, v) for g, part, v in [("a", 1, 1.0), ("a", 2, 3.0), ("a", 2, None), ("b", 1, None), (None, 2, 4.0)]]
    df = spark.createDataFrame(rows, "g string, part int, v double")
    measures = {kind: Measure(kind, F.col("v")) for kind in ("count", "sum", "min", "max", "avg")}
    merged = merge_states(partial_states(df, ["part", "g"], measures), ["g"], measures)
    whole = df.groupBy("g").agg(*[getattr(F, kind)("v").alias(kind) for kind in measures])
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))


@pytest.fixture(scope="module")
def bronze(tmp_path_factory):
    import json

    def write(path, records):
        path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in records), encoding="utf-8")

    return write_bronze(tmp_path_factory.mktemp("bronze"), write)


def test_run_by_run_equals_the_full_rebuild(spark, bronze, tmp_path):
    full, stepwise = f"{tmp_path}/full", f"{tmp_path}/stepwise"
    silver.write_silver(spark, bronze, full)
    # The newer run first: the older one may not bring its versions back.
    for runs in (["20240202_060000"], ["20240131_060000"], ["20240131_060000", "20240202_060000"]):
        silver.write_silver(spark, bronze, stepwise, runs)
    names = ["properties", "projects"]
    wanted, found = read_tables(spark, full, names), silver.read_silver(spark, stepwise, names)
    for name in names:
        assert found[name].columns == wanted[name].columns
        assert sorted(map(str, found[name].collect())) == sorted(map(str, wanted[name].collect()))
    for folder in (full, stepwise):
        states.write_gold(spark, folder, f"{folder}-gold")
    for name in gold.TABLES:
        by_folder = [sorted(map(str, spark.read.parquet(f"{folder}-gold/{name}").collect())) for folder in (full, stepwise)]
        assert by_folder[0] == by_folder[1], name
    silver.write_silver(spark, bronze, stepwise)
    assert not buckets.is_bucketed(spark, f"{stepwise}/{silver.LISTINGS}")


def test_a_listing_that_changes_or_leaves_moves_the_states(spark, bronze):
    from homelake import schemas
    from homelake.sources import read_entity, run_glob, with_run_id

    folder = f"{bronze}/../{uuid.uuid4().hex}"
    raw = with_run_id(read_entity(spark, run_glob(bronze, "properties"), schemas.BRONZE["properties"]), "properties")
    silver.upsert_listings(raw, folder, 8)
    assert all(states.refresh_states(spark, folder, f"{folder}-states").values())
    later = F.col("last_modified_date") + 10**9
    left = raw.where("id = '5'").withColumns({"min_selling_price": F.lit(None).cast("double"), "last_modified_date": later})
    moved = raw.where("id = '6'").withColumns({"ward": F.lit("W9"), "last_modified_date": later})
    touched = silver.upsert_listings(left.unionByName(moved).withColumn(RUN_ID, F.lit("3")), folder)
    assert states.refresh_states(spark, folder, f"{folder}-states") == dict.fromkeys(states.NAMES, touched)
    assert not any(states.refresh_states(spark, folder, f"{folder}-states").values())
    listings = silver.current_listings(buckets.read_buckets(spark, folder)).cache()
    for name in states.NAMES:
        found = states.merged_dashboard(spark, f"{folder}-states", name)
        wanted = gold.TABLES[name][0](listings).select(found.columns)
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect())), name
    assert states.merged_dashboard(spark, f"{folder}-states", "price_by_ward").where("ward = 'W9'").count() == 1
