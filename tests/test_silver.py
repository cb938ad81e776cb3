import pytest
from pyspark.sql import functions as F

from homelake.plans import silver
from tests.listings import write_bronze


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    import json

    def write(path, records):
        path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in records), encoding="utf-8")

    bronze = write_bronze(tmp_path_factory.mktemp("bronze"), write)
    return {name: table.cache() for name, table in silver.build_silver(spark, bronze).items()}


def by(table, key="id"):
    return {row[key]: row for row in table.collect()}


def test_column_counts(tables):
    widths = {name: len(table.columns) for name, table in tables.items()}
    assert widths == {
        "properties": 43, "projects": 51, "project_amenities": 4, "subdivisions": 21, "project_prices": 5,
    }


def test_properties_keep_the_newest_complete_listing(tables):
    rows = by(tables["properties"])
    assert set(rows) == {"1", "5", "6", "7", "8", "9", "10", "11", "12", "13"}
    assert rows["1"]["project_name"] == "Grand-Park S2A"
    assert rows["1"]["last_modified_date"] == "02-02-2024"
    assert (rows["1"]["lat"], rows["1"]["view_count"], rows["1"]["number_of_bathrooms"]) == (10.12345, 3, 2.0)
    assert rows["1"]["furniture_status"] == "Cơ bản"
    assert rows["13"]["lat"] is None


def test_property_views_and_texts(tables):
    views = {key: row["views"] for key, row in by(tables["properties"]).items()}
    assert views == {
        "1": "Hồ", "5": "Không Xác Định", "6": "Khác", "7": "Khác", "8": "Hồ", "9": "Nghĩa Trang / Khu Mộ",
        "10": "Đất Trống", "11": "Nội Khu", "12": "Nội Khu", "13": "X Y",
    }
    rows = by(tables["properties"])
    assert rows["10"]["inventory_code"] == "a High-quality b"
    assert (rows["8"]["min_selling_price"], rows["8"]["max_selling_price"]) == (2, 4)


def test_projects(tables):
    rows = by(tables["projects"])
    assert set(rows) == {"p1", "p2", "77"}
    p1 = rows["p1"]
    assert (p1["number_ele_min"], p1["number_ele_max"]) == (4.0, None)
    assert (p1["number_basement_min"], p1["number_basement_max"]) == (1.0, 3.0)
    assert (str(p1["handover_date_from"]), p1["construction_start_date_from"]) == ("2026-03-01", None)
    assert (p1["min_unit_price"], p1["max_unit_price"], p1["demand_code"]) == (2, 4, "SECONDARY, PRIMARY")
    assert rows["p2"]["name"] == "Empty, newer"
    assert str(rows["77"]["handover_date_from"]) == "2024-01-05"


def test_amenities(tables):
    rows = sorted((r["amenity_code"] or "", r["amenity_id"], r["amenity_name"]) for r in tables["project_amenities"].collect())
    assert rows == [("", "5", "n1"), ("c1", "11", "Xe buýt"), ("c2", "2", "Công viên"), ("c3", "3", "Vincom")]


def test_amenities_by_their_own_key_keep_every_attribute(spark, tmp_path, write_jsonl):
    from homelake import schemas
    from homelake.sources import read_entity, run_glob

    bronze = write_bronze(tmp_path / "b", write_jsonl)
    raw = read_entity(spark, run_glob(bronze, "projects"), schemas.PROJECT_QUALITY)
    rows = silver.project_amenities(raw, keys=("project_id", "amenity_id")).collect()
    assert sorted(r["amenity_id"] for r in rows) == ["11", "12", "2", "3", "5", "6"]


def test_subdivisions_and_prices(tables):
    s1 = by(tables["subdivisions"])["s1"]
    assert (s1["name"], s1["number_ele_max"], str(s1["handover_date_to"])) == ("S one", 4.0, "2025-12-31")
    prices = sorted((r["project_id"], r["year"] or 0, r["month"], r["price_average"]) for r in tables["project_prices"].collect())
    assert prices == [
        ("gone", 2024, 3, 1.0), ("p1", 0, 1, 9.0), ("p1", 2023, 11, 5.0), ("p1", 2024, 3, 10.0), ("p1", 2024, 3, 30.0),
        ("s1", 2024, 3, 99.0),
    ]


def test_a_malformed_line_stops_silver(spark, tmp_path, write_jsonl):
    bronze = write_bronze(tmp_path / "b", write_jsonl)
    write_jsonl(tmp_path / "b" / "properties_20240203_060000.jsonl", ['{"id": "14", "min_area": '])
    with pytest.raises(Exception, match="(?i)malformed"):
        silver.build_silver(spark, bronze)["properties"].collect()


def test_version_choice_ignores_how_the_day_text_sorts(spark):
    rows = [("a", 1706659200000, "31"), ("a", 1706832000000, "02"), ("b", None, "none"), ("b", 5, "some")]
    from homelake.operators import latest_per_key

    newest = latest_per_key(spark.createDataFrame(rows, "id string, t bigint, v string"), ["id"], ["t"])
    assert {r["id"]: r["v"] for r in newest.collect()} == {"a": "02", "b": "some"}


def test_write_silver_then_read_back(spark, tmp_path, write_jsonl):
    bronze, target = write_bronze(tmp_path / "b", write_jsonl), str(tmp_path / "silver")
    silver.write_silver(spark, bronze, target)
    silver.write_silver(spark, bronze, target)
    prices = spark.read.parquet(f"{target}/project_prices")
    assert prices.count() == 6
    assert spark.read.parquet(f"{target}/properties").where(F.col("id") == "1").count() == 1
