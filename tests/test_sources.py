import json

import pytest
from pyspark.sql import functions as F

from homelake import operators as op
from homelake.plans.gold import sum_by_key
from homelake.session import cut_lineage
from homelake.sources import drop_keys, extract_embedded_json, load_fixture, read_table, spread_order


def test_fixture_loader(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"x": 1, "y": "p"}, {"x": 2}]))
    (tmp_path / "b.csv").write_text("x,y\n1,2\n3,\n")
    assert sorted(r["x"] for r in load_fixture(spark, str(tmp_path / "a.json")).collect()) == [1, 2]
    csv = load_fixture(spark, str(tmp_path / "b.csv"))
    assert [kind for _, kind in csv.dtypes] == ["string", "string"] and csv.count() == 2
    with pytest.raises(ValueError):
        load_fixture(spark, "c.xml")


def test_catalog_table(spark):
    trips = spark.createDataFrame([(1, 2.0), (1, 3.0), (2, 4.0)], "pickup_zip int, fare_amount double")
    trips.createOrReplaceTempView("trips")
    totals = sum_by_key(read_table(spark, "trips"), "pickup_zip", "fare_amount", "total_fare")
    assert {r["pickup_zip"]: r["total_fare"] for r in totals.collect()} == {1: 5.0, 2: 4.0}


@pytest.mark.parametrize("html", [
    "", None, "<script>{}</script>", '<script id="__NEXT_DATA__">{"props": {}}</script>', '<script id="__NEXT_DATA__"></script>',
    '<script id="__NEXT_DATA__">{"props": {"pageProps": {"fallback": {"a": {"data": [{"id": 1}]}}}}} x</script>',
    '<script id="__next_data__">{"props": {"pageProps": {"fallback": {"a": {"data": [{"id": 1}]}}}}}</script>',
    '<script data-id="__NEXT_DATA__">{"props": {"pageProps": {"fallback": {"a": {"data": [{"id": 1}]}}}}}</script>',
    '<script id="__NEXT_DATA__">{"props": {"pageProps": {"fallback": [{"data": [{"id": 1}]}]}}}</script>',
])
def test_pages_without_records(spark, html):
    pages = spark.createDataFrame([(1, html)], "page int, html string")
    assert extract_embedded_json(pages, "page", "html").count() == 0


def test_records_keep_source_order_and_values(spark):
    text = '{"props": {"pageProps": {"fallback": {"z": {"data": [{"id": 1, "name": "Đông </b> \\" x", "p": 1.5}]}, "a": {"data": [{"id": 2}]}}}}}'
    pages = spark.createDataFrame([(1, f"<SCRIPT async id=__NEXT_DATA__ >{text}</script><script id='__NEXT_DATA__'>{{}}</script>")],
                                  "page int, html string")
    rows = extract_embedded_json(pages, "page", "html").orderBy("entry_pos").collect()
    assert [json.loads(r["record"]) for r in rows] == [{"id": 1, "name": 'Đông </b> " x', "p": 1.5}, {"id": 2}]


def test_drop_keys_keeps_value_types(spark):
    frame = spark.createDataFrame([('{"a": 1, "urls": [1], "b": {"urls": 2}, "c": null, "d": "1"}',), ("[1]",), (None,)], "j string")
    kept = [r[0] for r in frame.select(drop_keys(F.col("j"), ["urls"])).collect()]
    assert kept == ['{"a":1,"b":{"urls":2},"c":null,"d":"1"}', None, None]


def test_spread_order_is_sorted_and_complete(spark):
    frame = spark.createDataFrame([(i % 3,) for i in range(100)], "k int")
    assert [r["k"] for r in spread_order(frame, F.col("k").asc_nulls_last()).collect()] == sorted(i % 3 for i in range(100))


def test_profiles(spark):
    frame = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    assert [tuple(r) for r in op.table_profile(frame).orderBy("position").collect()] == [
        (0, "a", "int", 3, 1), (1, "b", "string", 3, 2)]
    docs = spark.createDataFrame([('{"a": 1, "l": []}',), ('{"a": "x", "l": [null]}',), ("broken",), (None,)], "j string")
    assert sorted(tuple(r) for r in op.json_profile(docs, "j").collect()) == [
        ("a", "text", 1), ("a", "whole", 1), ("l", "list", 1), ("l", "list[null]", 1)]


def test_too_many_months_are_refused(spark):
    series = spark.range(10_001).select(F.col("id").alias("year"), F.lit(1).alias("month"))
    with pytest.raises(ValueError):
        op.series_keys(series, "year", "month")


def test_intermediate_tables_go_to_the_shared_folder(spark, tmp_path, monkeypatch):
    frame = spark.range(5).select(F.col("id"), F.lit("x").alias("t"))
    assert cut_lineage(frame).count() == 5
    monkeypatch.setattr("homelake.session.shared_folder", lambda _: str(tmp_path))
    stored = cut_lineage(frame)
    assert stored.inputFiles() and all(str(tmp_path) in name for name in stored.inputFiles())
    assert sorted(stored.collect()) == sorted(frame.collect())
