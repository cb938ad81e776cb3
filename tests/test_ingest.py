import json

import pytest

from homelake.plans import ingest, silver
from homelake.plans.jobs import RESPONSES, run_ingest
from homelake.sources import history_ids, read_entity, run_glob
from homelake import schemas


def page(*entries, tag='<script id="__NEXT_DATA__" type="application/json">'):
    fallback = {f"k{9 - i}": entry for i, entry in enumerate(entries)}  # names sort against source order
    return f"<html><p>x</p>{tag}{json.dumps({'props': {'pageProps': {'fallback': fallback}}})}</script></html>"


def items(*ids):
    return [{"id": i, "urls": ["u"], "galleries": {}, "image_urls": 1, "images": None, "min_area": 5} for i in ids]


@pytest.fixture()
def responses(spark):
    def body(data):
        return json.dumps(data)

    pages = [
        (1, page({"data": items("a", "b")}, {"data": {"items": items("a", "c")}}, {"data": "x"})),
        (2, page({"data": items("c", "d")})),
        (3, page({"data": items("a", "old")})),
        (4, page({"data": items("later")})),
    ]
    listed = [
        {"id": "p1", "name": "One"}, {"id": "p2", "name": "Two"}, {"id": "p3", "name": "Đất THỔ CƯ"}, {"id": "", "name": "none"},
        {"id": None}, {"id": 0, "name": "zero"}, {"id": "p4"},
    ]
    details = [
        ("p1", body({"data": {"id": "p1", "name": "One, detailed", "insight_by_sector": [
            {"sector_id": "s1", "sector_name": "S1"}, {"object_code": "o2", "sector_id": "s2"}]}})),
        ("p2", body({"error": 1})),
        ("p9", body({"data": {"id": "p9", "insight_by_sector": [{"sector_id": "s9"}]}})),
    ]
    history = [("p1", body({"data": {"value": [{"unit": 1, "year": 2024, "price_average": 3, "percent": 0.5}]}})), ("p4", body({}))]
    charts = [("p1", body({"data": [1, 2]}))]
    return {
        "pages": spark.createDataFrame(pages, "page bigint, html string"),
        "quick_filter": spark.createDataFrame([(body({"data": {"property_projects": listed}}),)], "body string"),
        "details": spark.createDataFrame(details, "id string, body string"),
        "price_history": spark.createDataFrame(history, "project_id string, body string"),
        "price_charts": spark.createDataFrame(charts, "project_id string, body string"),
    }


def test_new_properties_stop_at_the_first_stale_page(spark, responses):
    seen = spark.createDataFrame([("old",)], "id string")
    rows = ingest.new_properties(responses["pages"], seen).collect()
    assert sorted((r["page"], r["entry_pos"], r["item_pos"], r["id"]) for r in rows) == [
        (1, 0, 0, "a"), (1, 0, 1, "b"), (1, 1, 1, "c"), (2, 0, 1, "d")]
    assert {r["record"] for r in rows if r["id"] == "a"} == {'{"id":"a","min_area":5}'}


def test_a_missing_or_empty_page_stops_too(spark, responses):
    seen = spark.createDataFrame([("none",)], "id string")
    gap = responses["pages"].where("page <> 2")
    assert {r["page"] for r in ingest.new_properties(gap, seen).collect()} == {1}
    assert ingest.new_properties(gap.where("page > 1"), seen).count() == 0


def test_unreadable_pages_are_kept_apart_and_end_nothing(spark):
    def raw(text):
        return f'<script id="__NEXT_DATA__">{text}</script>'

    rows = [
        (1, page({"data": items("a")})),
        (2, raw('{"props": {"pageProps": {"fallback": {"k": {"data": [{"id": "b"}]}}')),
        (3, raw('{"props": {"pageProps": {"fallback": {"k": {"data": [{"id": "c", "x": NaN, "in": {"y": 1, "y": 2}}]}}}}} tail')),
        (4, raw('{"props": {"pageProps": {"fallback": {"k": {"data": [{"id": "d", "in": {"y": 1, "y": 2}}, {"z": 1}]}}}}}')),
        (5, page({"data": [{"no": "id"}]})),
        (6, page({"data": items("late")})),
    ]
    pages = spark.createDataFrame(rows, "page bigint, html string")
    seen = spark.createDataFrame([("none",)], "id string")
    assert sorted(r["id"] for r in ingest.new_properties(pages, seen).collect()) == ["a", "d"]
    assert sorted(r["page"] for r in ingest.rejected_pages(pages).collect()) == [2, 3]


def test_projects_and_subdivisions(responses):
    listed = ingest.listed_projects(responses["quick_filter"])
    assert sorted(r["id"] for r in listed.collect()) == ["p1", "p2", "p4"]
    details = ingest.response_data(responses["details"], "id", "record")
    projects = {r["id"]: json.loads(r["record"]) for r in ingest.detailed_projects(listed, details).collect()}
    assert {k: v.get("name") for k, v in projects.items()} == {"p1": "One, detailed", "p2": "Two", "p4": None}
    sectors = [json.loads(r["record"]) for r in ingest.listed_subdivisions(listed, details).collect()]
    assert sorted(sectors, key=str) == [
        {"object_code": "o2", "sector_id": "s2", "project_id": "p1"}, {"sector_id": "s1", "sector_name": "S1", "project_id": "p1"}]


def test_a_run_writes_once_and_the_next_only_what_is_new(spark, responses, tmp_path):
    for name in RESPONSES:
        responses[name].write.parquet(f"{tmp_path}/responses/{name}")
    bronze = f"{tmp_path}/bronze"
    first = run_ingest(spark, f"{tmp_path}/responses", bronze, "20240101_000000")
    # The id "old" is new in an empty lake, so page 3 is not stale and page 4 follows.
    assert first == {"properties": 6, "projects": 3, "subdivisions": 2, "project_prices": 5, "rejected_pages": 0}
    assert {r["id"] for r in history_ids(spark, run_glob(bronze, "properties"), "id").collect()} == {
        "a", "b", "c", "d", "old", "later"}

    prices = [json.loads(r["value"]) for r in spark.read.text(run_glob(bronze, "project_prices")).collect()]
    by_id = {p["project_id"]: p for p in prices}
    assert set(by_id) == {"p1", "p2", "p4", "s1", "o2"}
    assert by_id["p1"]["price_chart"] == [1, 2] and by_id["p1"]["price_history"]["value"][0]["unit"] == 1
    assert (by_id["p4"]["price_history"], by_id["p4"]["price_chart"]) == ({}, None)
    assert by_id["p2"]["price_history"] is None

    second = run_ingest(spark, f"{tmp_path}/responses", bronze, "20240102_000000")
    assert second == {"properties": 0, "projects": 3, "subdivisions": 2, "project_prices": 0, "rejected_pages": 0}
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        run_ingest(spark, f"{tmp_path}/responses", bronze, "20240102_000000")

    tables = silver.build_silver(spark, bronze)
    assert sorted(r["id"] for r in tables["projects"].collect()) == ["p1", "p2", "p4"]
    assert [(r["project_id"], r["month"], r["price_average"]) for r in tables["project_prices"].collect()] == [("p1", 1, 3.0)]


def test_price_targets_fall_through_candidate_keys(spark):
    def records(*texts):
        return spark.createDataFrame([(text,) for text in texts], "record string")

    projects = records('{"id": "p1"}', '{"object_code": "o1"}')
    sectors = records('{"sector_id": "s1"}', '{"object_code": "o2"}', '{"id": "", "object_code": "o3"}', '{"id": "p1"}', '{"id": 0}')
    visited = spark.createDataFrame([("o2",)], "project_id string")
    found = ingest.price_targets(projects, sectors, visited).collect()
    assert sorted(r["project_id"] for r in found) == ["o1", "p1", "s1"]


def test_history_skips_bad_lines_and_rows_without_key(spark, tmp_path, write_jsonl):
    write_jsonl(tmp_path / "properties_1.jsonl", [{"id": 1}, '{"id": "2", ', {"other": 3}, {"id": "1"}])
    write_jsonl(tmp_path / "properties_2.jsonl", [{"id": "3", "x": {}}, "nonsense"])
    found = history_ids(spark, run_glob(str(tmp_path), "properties"), "id")
    assert sorted(r["id"] for r in found.collect()) == ["1", "3"]
    assert history_ids(spark, run_glob(str(tmp_path), "project_prices"), "project_id").count() == 0


def test_runs_are_read_together_from_files_and_folders(spark, tmp_path, write_jsonl):
    from homelake.sources import append_run, with_run_id

    write_jsonl(tmp_path / "properties_20240101_000000.jsonl", [{"id": 1, "min_area": 2}])
    records = spark.createDataFrame([('{"id":"2","view_count":{"count":4}}',)], "record string")
    assert append_run(records, str(tmp_path), "properties", "20240102_000000") == 1
    raw = with_run_id(read_entity(spark, run_glob(str(tmp_path), "properties"), schemas.PROPERTIES), "properties")
    assert sorted((r["id"], r["__run_id"]) for r in raw.collect()) == [("1", "20240101_000000"), ("2", "20240102_000000")]
