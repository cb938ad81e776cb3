import pytest

from homelake.plans import features, gold, silver
from homelake.plans.jobs import main
from tests.listings import write_bronze


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    import json

    def write(path, records):
        path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in records), encoding="utf-8")

    root = tmp_path_factory.mktemp("layers")
    bronze = write_bronze(root / "bronze", write)
    main(["silver", "--bronze-dir", bronze, "--silver-dir", f"{root}/silver", "--shuffle-partitions", "6"])
    main(["gold", "--silver-dir", f"{root}/silver", "--gold-dir", f"{root}/gold"])
    main(["features", "--silver-dir", f"{root}/silver", "--gold-dir", f"{root}/gold"])
    return str(root)


def rows(spark, layers, name):
    return [r.asDict() for r in spark.read.parquet(f"{layers}/gold/{name}").collect()]


def test_every_dashboard_table_is_written(spark, layers):
    for name in gold.build_gold({n: spark.read.parquet(f"{layers}/silver/{n}") for n in silver.TABLES}):
        assert rows(spark, layers, name), name


def test_price_by_ward(spark, layers):
    (row,) = rows(spark, layers, "price_by_ward")
    assert (row["total_properties"], row["lowest_price"], row["highest_price"]) == (10, 2, 2000)


def test_summary_counts_missing_flags_as_no(spark, layers):
    (row,) = rows(spark, layers, "property_summary")
    assert (row["total_supply"], row["urgent_sale_count"], row["cut_loss_count"], row["avg_unit_price"]) == (10, 9, 0, 15.0)


def test_area_edges_fall_into_the_middle_bin(spark, layers):
    assert {r["area_bin"]: r["total_supply"] for r in rows(spark, layers, "property_area_bins")} == {"50-80m2": 10}


def test_monthly_prices_leave_out_subdivision_series(spark, layers):
    found = {(r["district"], r["year"], r["month"]): (r["avg_price"], r["avg_percent_change"])
             for r in rows(spark, layers, "price_history_monthly")}
    assert found == {("Q9", 2024, 3): (20.0, 1.0), ("Q9", 2023, 11): (5.0, 2.0), ("Q9", None, 1): (9.0, 0.0)}


def test_developer_pricing(spark, layers):
    (row,) = rows(spark, layers, "developer_pricing")
    assert (row["developer_name"], row["total_projects"], row["avg_unit_price"]) == ("Dev", 2, 3.0)
    assert (str(row["min_handover_date"]), str(row["max_handover_date"])) == ("2024-01-05", "2026-03-01")


def test_project_quality_counts_none_as_zero(spark, layers):
    found = {r["id"]: (r["amenity_count"], r["monthly_service_fee"]) for r in rows(spark, layers, "project_quality")}
    assert found == {"p1": (4, 7.0), "p2": (0, None), "77": (0, None)}


def test_area_boxplot(spark, layers):
    (row,) = rows(spark, layers, "subdivision_area_boxplot")
    assert (row["min_carpet_area"], row["max_carpet_area"], row["median_carpet_area"]) == (50.0, 80.0, 55.0)


def test_subdivision_metrics(spark, layers):
    found = {r["subdivision_id"]: (r["project_name"], r["avg_prop_per_floor"], r["avg_ele"])
             for r in rows(spark, layers, "subdivision_metrics")}
    assert found == {"s1": ("Grand Park", 4.5, 3.0), "s2": (None, None, None)}


def test_handover_and_heatmap(spark, layers):
    assert [r["project_id"] for r in rows(spark, layers, "project_handover_timeline")] == ["77", "p1"]
    (cell,) = rows(spark, layers, "geo_heatmap")
    assert (cell["lat_bin"], cell["long_bin"], cell["property_count"]) == (10.123, 106.5, 9)


def test_feature_table_shape(spark, layers):
    table = spark.read.parquet(f"{layers}/gold/features")
    months = [c for c in table.columns if c.startswith("price_")]
    assert months == ["price_2023_11", "price_2024_03"]
    assert len(table.columns) == 43 + 37 + 2 + 2 + 21
    assert table.columns[-21:] == features.DERIVED_COLUMNS
    assert {"lat", "long", "lat_1", "long_1"} <= set(table.columns)
    assert table.count() == 10


def test_feature_values(spark, layers):
    found = {r["id"]: r for r in rows(spark, layers, "features")}
    one = found["1"]
    assert (one["price_2024_03"], one["price_2023_11"], one["amenity_score"], one["core_amenity_score"]) == (30.0, 5.0, 4, 11)
    assert (one["bedroom_count"], one["rank"], one["window_direction"]) == ("1-2PN", "Cao cấp", "Đông")
    assert (one["is_secondary_only"], one["has_primary"], one["premium_transit_flag"]) == (0, 1, 1)
    assert (one["bathroom_per_sqm"], one["furniture_status_encoded"], one["floor_num"]) == (0.04, 1.0, 12.0)
    assert (one["is_corner"], one["area_discount_ratio"], one["is_special_low_floor"]) == (1, 60.0, 0)
    assert (one["density_vs_location"], one["boutique_index"], one["lat_1"]) == (2.0, 0.0, 10.1)
    assert found["9"]["cemetery_penalty_interaction"] == 3
    assert one["block_price_volatility"] > 0
    assert (found["5"]["block_price_volatility"], found["11"]["block_price_volatility"]) == (0.0, 0.0)
    assert (found["11"]["amenity_score"], found["11"]["rank"], found["11"]["price_2024_03"]) == (0, "Bình dân", None)
    assert found["12"]["price_2024_03"] == 1.0  # prices count although the project record is missing


def test_sample_report(spark, layers):
    report = rows(spark, layers, "features_sample")
    assert len(report) == 10 and set(report[0]) == set(features.REPORT_COLUMNS)
    assert {r["block_price_volatility"] for r in report if r["id"] in ("5", "11")} == {"0"}


@pytest.mark.parametrize("value, label", [(None, "Unknown"), (0.0, "Studio"), (2.0, "1-2PN"), (3.0, "3PN"), (5.0, "Oversized"),
                                          (1.5, "Oversized"), (-1.0, "Oversized"), (float("nan"), "Unknown")])
def test_bedroom_class(spark, value, label):
    frame = spark.createDataFrame([(value,)], "v double")
    assert frame.select(features.bedroom_class(frame.v)).first()[0] == label


@pytest.mark.parametrize("demand, flags", [("SECONDARY", (1, 0)), ("SECONDARY, PRIMARY", (0, 1)), (None, (0, 0)), ("primary", (0, 0))])
def test_demand_flags(spark, demand, flags):
    frame = spark.createDataFrame([(demand,)], "v string")
    assert tuple(frame.select(*features.demand_flags(frame.v)).first()) == flags


def test_boutique_index(spark):
    frame = spark.createDataFrame([(8.0, 4.0), (8.0, 0.0), (8.0, None), (None, 2.0), (-8.0, 4.0)], "a double, b double")
    assert [r[0] for r in frame.select(features.boutique_index(frame.a, frame.b)).collect()] == [0.5, 0.0, 0.0, 0.0, 0.0]


def test_first_number(spark):
    frame = spark.createDataFrame([("Tầng 12A",), ("Thấp",), (None,), ("3-4",)], "v string")
    assert [r[0] for r in frame.select(features.first_number(frame.v)).collect()] == [12.0, None, None, 3.0]


def test_features_over_split_hot_keys_are_the_same(spark, layers):
    tables = {n: spark.read.parquet(f"{layers}/silver/{n}") for n in silver.TABLES}
    plain = sorted(map(str, features.features(tables).collect()))
    assert sorted(map(str, features.features(tables, hot_rows=1).collect())) == plain
