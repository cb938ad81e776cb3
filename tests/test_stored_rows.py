"""Wide rows chosen by position: only narrow columns are shuffled and sorted to choose them."""

import random
from statistics import stdev

import pytest
from pyspark.sql import functions as F

from homelake import schemas
from homelake.operators import dedupe
from homelake.plans import features, silver
from homelake.sources import buckets
from homelake.sources.readers import RUN_ID


@pytest.mark.parametrize("most", [1 << 30, 0])
def test_latest_stored_is_latest_per_key(spark, monkeypatch, most):
    monkeypatch.setattr(dedupe, "MARKED_ROWS", most)
    rng = random.Random(8)
    rows = [(rng.choice([None, *map(str, range(200))]), rng.choice([None, *range(4)]), rng.randrange(9)) for _ in range(5000)]
    df = spark.createDataFrame(rows, "key string, at long, note int").repartition(3)
    wanted = dedupe.latest_per_key(df, ["key"], ["at", "note"])
    found = dedupe.latest_stored(df, ["key"], ["at", "note"])
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect())) and found.columns == df.columns


@pytest.mark.parametrize("most", [1 << 30, 0])
def test_rows_at_keeps_or_drops(spark, monkeypatch, most):
    monkeypatch.setattr(dedupe, "MARKED_ROWS", most)
    stored = dedupe.cut_lineage(dedupe.with_position(spark.range(5000).repartition(3)))
    chosen = stored.where("id % 7 = 0")
    for keep in (True, False):
        found = {r["id"] for r in dedupe.rows_at(stored, chosen, keep).collect()}
        assert found == {i for i in range(5000) if (i % 7 == 0) == keep}


def test_listings_are_not_sorted_whole(spark):
    raw = spark.createDataFrame([], schemas.PROPERTIES).selectExpr("*", f"'1' AS {RUN_ID}")
    plan = silver.properties(raw)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan


def test_chosen_listings_are_read_where_they_stand(spark):
    raw = spark.createDataFrame([], schemas.PROPERTIES).selectExpr("*", f"'1' AS {RUN_ID}")
    plan = silver.properties(raw)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_an_upsert_stores_wide_rows_once(spark, monkeypatch, tmp_path):
    stored, keep = [], dedupe.cut_lineage
    for module in (dedupe, buckets):
        monkeypatch.setattr(module, "cut_lineage", lambda df, **options: stored.append(len(df.columns)) or keep(df, **options))
    raw = spark.createDataFrame([("1", 5.0), ("1", 6.0), (None, 1.0)], "id string, min_selling_price double")
    wide = raw.select(*[raw[f.name] if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.PROPERTIES.fields])
    for run in ("1", "2"):
        silver.upsert_listings(wide.withColumn(RUN_ID, F.lit(run)), str(tmp_path), 4)
    assert sum(n > len(schemas.PROPERTIES.fields) for n in stored) == 2
    found = buckets.read_buckets(spark, str(tmp_path)).select("id", RUN_ID).collect()
    assert sorted(map(str, found)) == sorted(["Row(id='1', __run_id='2')", "Row(id=None, __run_id='2')"])


def test_sector_statistics_are_met_without_a_shuffle_of_listings(spark):
    def records(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    offers = [{"id": str(i), "sector_id": str(i % 3) if i else None, "min_selling_price": float(i * i), "min_area": 5.0, "views": ["k"]} for i in range(9)]
    tables = {
        "properties": dedupe.cut_lineage(silver.properties(records(schemas.PROPERTIES, *offers))),
        "projects": silver.projects(records(schemas.PROJECTS)),
        "project_amenities": silver.project_amenities(records(schemas.PROJECT_QUALITY)),
        "project_prices": silver.project_prices(records(schemas.PROJECT_PRICES)),
    }
    table = features.features(tables, ["price_2024_01"])
    assert "hashpartitioning(sector_id" not in table._jdf.queryExecution().executedPlan().toString()
    found = {row["id"]: row["block_price_volatility"] for row in table.collect()}
    wanted = {str(i): stdev(j * j for j in range(1, 9) if j % 3 == i % 3) if i else 0.0 for i in range(9)}
    assert found == pytest.approx(wanted)
