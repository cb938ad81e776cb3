"""Bronze: new records from fetched pages and API responses, written as run-stamped JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homelake.functions import compact, is_container, is_json, json_objects, last_of_each_key, parse_whole
from homelake.operators import (
    collect_keys,
    json_key,
    not_containing,
    one_per_key,
    prefix_until_stale,
    present_key,
    with_fallback,
)
from homelake.session import cut_lineage
from homelake.sources import add_seen, append_run, extract_embedded_json, seen_ids, unreadable_pages

# The kind of project that is left out, and where records sit in the responses.
EXCLUDED_PROJECT_WORD = "thổ cư"
PROJECT_LIST = "property_projects"


def new_properties(pages: DataFrame, history: DataFrame, first_page: int = 1, long_history: bool = False) -> DataFrame:
    """Unseen listings of pages (page, html), as (page, entry_pos, item_pos, id, record), up to the first
    page without any.  A page that cannot be read does not end the crawl (see :func:`rejected_pages`)."""
    records = extract_embedded_json(pages, "page", "html")
    keyed = records.withColumn("id", F.get_json_object("record", "$.id"))
    unread = rejected_pages(pages).select("page")
    return prefix_until_stale(keyed, history, "page", ["entry_pos", "item_pos"], "id", first_page, unread, long_history)


def rejected_pages(pages: DataFrame) -> DataFrame:
    """(page, script): pages (page, html) whose data script is no valid JSON."""
    return unreadable_pages(pages, "page", "html")


def listed_projects(quick_filter: DataFrame) -> DataFrame:
    """(id, pos, record) of the projects in quick-filter responses (body), without residential land and without
    projects that have no usable id."""
    found = parse_whole(F.col("body"), f"struct<data:struct<{PROJECT_LIST}:string>>")["data"][PROJECT_LIST]
    items = quick_filter.select(F.explode(json_objects(found)).alias("found"))
    records = items.select(F.col("found.pos").alias("pos"), compact(F.col("found.item")).alias("record"))
    name = F.get_json_object("record", "$.name")
    keyed = records.select(json_key(F.col("record"), "id").alias("id"), "pos", "record")
    return keyed.where(present_key(F.col("id")) & not_containing(name, EXCLUDED_PROJECT_WORD))


def response_data(responses: DataFrame, key: str, out: str) -> DataFrame:
    """(key, data part as JSON text) of the responses (key, body) whose data part is an object or a list, one per key."""
    data = parse_whole(F.col("body"), "struct<data:string>")["data"]
    rows = responses.select(key, data.alias(out)).where(is_container(F.col(out)))
    return one_per_key(rows.withColumn(out, compact(F.col(out))), [key])


def detailed_projects(listed: DataFrame, details: DataFrame) -> DataFrame:
    """(id, record): the detail record of each listed project, or the listed record where there is none.

    ``details`` is the :func:`response_data` (id, record) of the fetched responses.
    """
    return with_fallback(listed, details, "id", ["pos", "record"])


def listed_subdivisions(listed: DataFrame, details: DataFrame) -> DataFrame:
    """(record): sectors of the projects' detail records (id, record) as delivered, each with the key of its project."""
    found = details.join(listed.select("id").distinct(), "id", "left_semi")
    sectors = F.from_json("record", "insight_by_sector string")["insight_by_sector"]
    rows = found.select("id", F.explode(json_objects(sectors)).alias("found"))
    # The project's key stands last, so it holds where a sector brings one of its own.
    own = F.to_json(F.struct(F.col("id").alias("project_id")))
    members = F.regexp_replace(F.col("found.item"), r"\}\s*$", "")
    joint = F.when(members.rlike(r"^\{\s*$"), F.lit("")).otherwise(F.lit(","))
    return rows.select(compact_last(F.concat(members, joint, F.substring(own, 2, 1_000_000))).alias("record"))


def compact_last(record: Column) -> Column:
    """A record in which a repeated top-level key keeps its last value."""
    entries = last_of_each_key(F.from_json(record, "map<string,variant>"))
    return F.coalesce(F.to_json(F.map_from_entries(entries)), record)


def price_targets(projects: DataFrame, subdivisions: DataFrame, visited: DataFrame) -> DataFrame:
    """Ids of projects and subdivisions (record) whose prices were not fetched before, as ``project_id``.

    The keys are read from the stored record: a project whose detail record has no id is asked for by its object code.
    """

    def keys(df: DataFrame, names: list[str]) -> tuple[DataFrame, list[str]]:
        return df.select([json_key(F.col("record"), name).alias(name) for name in names]), names

    sources = [keys(projects, ["id", "object_code"]), keys(subdivisions, ["id", "object_code", "sector_id"])]
    return collect_keys(sources, visited, "project_id")


def price_records(targets: DataFrame, history: DataFrame, charts: DataFrame) -> DataFrame:
    """(record): project id with the data of its price history and chart responses, as JSON text.

    A missing response gives null, a response without data an empty object.
    """
    rows = targets
    for name, responses in (("price_history", history), ("price_chart", charts)):
        data = parse_whole(F.col("body"), "struct<data:string>")["data"]
        text = F.when(is_container(data), compact(data)).otherwise("{}")
        parts = responses.where(is_json(F.col("body"))).select("project_id", text.alias(name))
        rows = rows.join(one_per_key(parts, ["project_id"]), "project_id", "left")
    own = F.regexp_replace(F.to_json(F.struct("project_id")), r"\}$", "")
    fields = [F.concat(F.lit(f',"{name}":'), F.coalesce(name, F.lit("null"))) for name in ("price_history", "price_chart")]
    return rows.select(F.concat(own, *fields, F.lit("}")).alias("record"))


def ingest(
    spark: SparkSession,
    bronze_dir: str,
    run_id: str,
    pages: DataFrame,
    quick_filter: DataFrame,
    details: DataFrame,
    price_history: DataFrame,
    price_charts: DataFrame,
) -> dict[str, int]:
    """One run over tables of fetched responses; returns the number of records written per entity."""
    seen = seen_ids(spark, bronze_dir, "properties", "id")
    fresh = new_properties(pages, seen, long_history=True)
    written = {"properties": append_run(fresh.select("record"), bronze_dir, "properties", run_id)}
    add_seen(fresh, bronze_dir, "properties", "id", run_id)
    rejected = rejected_pages(pages).select(F.to_json(F.struct("page", "script")).alias("record"))
    written["rejected_pages"] = append_run(rejected, bronze_dir, "rejected_pages", run_id)

    # Each is read by several of the steps below.
    listed = cut_lineage(listed_projects(quick_filter))
    found = cut_lineage(response_data(details, "id", "record"))
    projects = cut_lineage(detailed_projects(listed, found))
    subdivisions = cut_lineage(listed_subdivisions(listed, found))
    written["projects"] = append_run(projects.select("record"), bronze_dir, "projects", run_id)
    written["subdivisions"] = append_run(subdivisions.select("record"), bronze_dir, "subdivisions", run_id)

    priced = seen_ids(spark, bronze_dir, "project_prices", "project_id")
    targets = cut_lineage(price_targets(projects, subdivisions, priced))
    records = price_records(targets, price_history, price_charts)
    written["project_prices"] = append_run(records, bronze_dir, "project_prices", run_id)
    add_seen(targets, bronze_dir, "project_prices", "project_id", run_id)
    return written
