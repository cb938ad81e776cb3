"""Ingestion on pages and responses that Spark derives from the test tables, and round trips through run files."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homelake.checks.common import Check, table
from homelake.plans import ingest
from homelake.session import shared_folder
from homelake.sources import append_run, history_ids, read_entity, run_glob, seen_ids, with_run_id
from homelake.sources.readers import RUN_ID
from homelake.streaming import new_records_query, read_new_records


def _text(template: str, **columns: str) -> Column:
    """JSON text with ``<name>`` places filled from columns."""
    text = F.lit(template)
    for place, column in columns.items():
        text = F.replace(text, F.lit(f"<{place}>"), F.col(column).cast("string"))
    return text


# ---- listings from pages: two per page, one of them new only while its number has not been seen, and one without id; some pages repeat
# ---- keys, hold NaN, hide a script in a comment or have broken JSON ---------------------------------------------


def _listing_pages(spark: SparkSession, sf: str) -> DataFrame:
    body = (
        '<script id="__NEXT_DATA__">{"props": {"pageProps": {"fallback": {"list": {"data": [<item>]},'
        ' "more": {"data": {"items": [{"id": "h4000", "images": 1}, {"page": 0}]}}<rest>}}}}</script>'
    )
    pages = table(spark, sf, "pages").withColumn("n", F.length("html") % 5000).withColumn("page", F.col("page_id") + 1)
    kind = F.col("page") % 6
    item = (
        F.when(kind == 1, _text('{"id": "first", "page": 0, "urls": 1, "id": "h<n>", "page": <p>}', n="n", p="page"))
        .otherwise(_text('{"id": "h<n>", "page": <p>, "urls": []}', n="n", p="page"))
    )
    rest = F.when(kind == 2, ', "more": {"data": []}, "more": 1').when(kind == 3, ', "x": NaN').when(kind == 4, ', "x": [').otherwise("")
    hidden = F.when(kind == 5, '<!-- <script id="__NEXT_DATA__">{"props": {}}</script> -->').otherwise("")
    shown = pages.withColumns({"item": item, "rest": rest})
    return shown.select("page", F.concat("html", hidden, _text(body, item="item", rest="rest")).alias("html"))


def _seen_listings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(F.concat(F.lit("h"), F.col("n_nationkey") + 4000).alias("id"))


def new_properties(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.new_properties(_listing_pages(spark, sf), _seen_listings(spark, sf))


NEW_PROPERTIES = """
WITH listed AS (SELECT page_id + 1 AS page, 'h' || (length(html) % 5000) AS id FROM pages WHERE (page_id + 1) % 6 <> 4),
fresh AS (SELECT id, min(page) AS page FROM listed
          WHERE id NOT IN (SELECT 'h' || (n_nationkey + 4000) FROM nation) GROUP BY id),
stop AS (SELECT min(page) AS page FROM (SELECT page FROM listed UNION SELECT max(page_id) + 2 FROM pages) AS p
         WHERE page NOT IN (SELECT page FROM fresh))
SELECT page, 0 AS entry_pos, 0 AS item_pos, '{"id":"' || id || '","page":' || page || '}' AS record, id
FROM fresh WHERE page < (SELECT page FROM stop)
"""

# ---- projects, subdivisions and prices from responses ----------------------------------------------------------

_LISTED = (
    '{"data": {"property_projects": [{"id": "p<k>", "name": "<name>"}, {"id": "", "name": "no id"}, '
    '{"id": "t<k>", "name": "Đất THỔ CƯ <k>"}]}}'
)
_DETAIL = (
    '{"data": {<id>"object_code": "c<k>", "name": "detail <name>", "insight_by_sector": ['
    '{"sector_id": "s<k>", "sector_name": "S", "min_selling_price": "12x", "project_id": "other", "field": {"new": 1}},'
    ' {"object_code": "o<k>", "sector_id": "z<k>"}, {"sector_id": 0}, {"object_code": false, "sector_id": "f<k>"}, 5]}}'
)
_HISTORY = '{"data": {"value": [{"unit": 1, "year": 2024, "price_average": <price>, "percent": 0.5}]}}'


def _responses(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("n"),
        F.floor("s_acctbal").alias("price"),
    )
    project = F.concat(F.lit("p"), "k")
    # Some detail records lack the id; their prices are asked for by object code.
    suppliers = suppliers.withColumn("id", F.when(F.col("n") % 4 == 1, "").otherwise(_text('"id": "p<k>", ', k="k")))
    detail = F.when(F.col("n") > 8, _text(_DETAIL, id="id", k="k", name="name")).otherwise('{"error": 1}')
    history = F.when(F.col("price") > 0, _text(_HISTORY, price="price")).otherwise("{}")
    return {
        "quick_filter": suppliers.select(_text(_LISTED, k="k", name="name").alias("body")),
        "details": suppliers.where(F.col("n") > 5).select(project.alias("id"), detail.alias("body")),
        "history": suppliers.where(F.col("n") % 2 == 0).select(project.alias("project_id"), history.alias("body")),
        "charts": suppliers.where(F.col("n") % 3 == 0).select(project.alias("project_id"), F.lit('{"data": [1]}').alias("body")),
        "visited": suppliers.where(F.col("n") == 20).select(project.alias("project_id")),
    }


def projects(spark: SparkSession, sf: str) -> DataFrame:
    given = _responses(spark, sf)
    rows = ingest.detailed_projects(ingest.listed_projects(given["quick_filter"]), ingest.response_data(given["details"], "id", "record"))
    return rows.select("id", F.get_json_object("record", "$.name").alias("name"))


PROJECTS = "SELECT 'p' || s_suppkey AS id, CASE WHEN s_nationkey > 8 THEN 'detail ' ELSE '' END || s_name AS name FROM supplier"


def subdivisions(spark: SparkSession, sf: str) -> DataFrame:
    given = _responses(spark, sf)
    return ingest.listed_subdivisions(ingest.listed_projects(given["quick_filter"]), ingest.response_data(given["details"], "id", "record"))


SUBDIVISIONS = """
SELECT replace(replace(record, '<k>', CAST(s_suppkey AS VARCHAR)), '<project>', ',"project_id":"p' || s_suppkey || '"}') AS record
FROM supplier, (VALUES
  ('{"field":{"new":1},"min_selling_price":"12x","sector_id":"s<k>","sector_name":"S"<project>'),
  ('{"object_code":"o<k>","sector_id":"z<k>"<project>'), ('{"sector_id":0<project>'), ('{"object_code":false,"sector_id":"f<k>"<project>')
) AS sectors(record) WHERE s_nationkey > 8
"""


def project_prices(spark: SparkSession, sf: str) -> DataFrame:
    given = _responses(spark, sf)
    listed = ingest.listed_projects(given["quick_filter"])
    details = ingest.response_data(given["details"], "id", "record")
    targets = ingest.price_targets(
        ingest.detailed_projects(listed, details), ingest.listed_subdivisions(listed, details), given["visited"]
    )
    return ingest.price_records(targets, given["history"], given["charts"])


PROJECT_PRICES = """
WITH targets AS (
  SELECT 'p' || s_suppkey AS id, s_nationkey AS n, CAST(floor(s_acctbal) AS BIGINT) AS price FROM supplier
  WHERE s_nationkey <> 20 AND NOT (s_nationkey > 8 AND s_nationkey % 4 = 1)
  UNION ALL SELECT 'c' || s_suppkey, NULL, NULL FROM supplier WHERE s_nationkey > 8 AND s_nationkey % 4 = 1
  UNION ALL SELECT 's' || s_suppkey, NULL, NULL FROM supplier WHERE s_nationkey > 8
  UNION ALL SELECT 'o' || s_suppkey, NULL, NULL FROM supplier WHERE s_nationkey > 8)
SELECT '{"project_id":"' || id || '","price_history":' ||
       CASE WHEN n IS NULL OR n % 2 = 1 THEN 'null' WHEN price > 0
            THEN '{"value":[{"percent":0.5,"price_average":' || price || ',"unit":1,"year":2024}]}' ELSE '{}' END ||
       ',"price_chart":' || CASE WHEN n % 3 = 0 THEN '[1]' ELSE 'null' END || '}' AS record
FROM targets
"""

# ---- run files ----------------------------------------------------------------------------------------------

_EVENT = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType()),
])


def _runs(spark: SparkSession, sf: str) -> list[tuple[str, DataFrame]]:
    """Two runs: events of kind purchase, then all others."""
    events = table(spark, sf, "events").withColumn("id", F.concat("user_id", F.lit("/"), F.floor("value")))
    early = F.col("event_type") == "purchase"
    columns = [field.name for field in _EVENT]
    return [("20240101_000000", events.where(early).select(columns)), ("20240102_000000", events.where(~early).select(columns))]


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/runs-{uuid4().hex}"


def run_files(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, keys and values per run as read back from the run files."""
    folder = _folder(spark)
    for run_id, records in _runs(spark, sf):
        append_run(records, folder, "events", run_id)
    # A run with broken lines and a record without id.
    bad = table(spark, sf, "region").select(F.explode(F.array(
        F.lit('{"id": "cut off'), F.lit("no JSON"), F.lit('{"event_id": 0}'), _text('{"id": "r<r>", "event_id": 1}', r="r_regionkey"))).alias("record"))
    append_run(bad, folder, "events", "20240103_000000")
    glob = run_glob(folder, "events")
    rows = with_run_id(read_entity(spark, glob, _EVENT, mode="DROPMALFORMED"), "events").withColumnRenamed(RUN_ID, "run_id")
    keys = history_ids(spark, glob, "id").agg(F.count("id").alias("known"))
    noted = seen_ids(spark, folder, "events", "id").agg(F.count("id").alias("noted"))
    summary = rows.groupBy("run_id").agg(
        F.count("id").alias("rows"), F.count_distinct("id").alias("ids"), F.sum("event_id").alias("total")
    )
    return summary.withColumns({"known": keys.scalar(), "noted": noted.scalar()})


RUN_FILES = """
WITH e AS (SELECT *, user_id || '/' || CAST(floor(value) AS BIGINT) AS id FROM events)
SELECT CASE WHEN event_type = 'purchase' THEN '20240101_000000' ELSE '20240102_000000' END AS run_id, count(id) AS rows,
       count(DISTINCT id) AS ids, CAST(sum(event_id) AS BIGINT) AS total, (SELECT count(DISTINCT id) FROM e) + (SELECT count(*) FROM region) AS known,
       (SELECT count(DISTINCT id) FROM e) + (SELECT count(*) FROM region) AS noted
FROM e GROUP BY ALL
UNION ALL
SELECT '20240103_000000', count(*), count(*), CAST(count(*) AS BIGINT), (SELECT count(DISTINCT id) FROM e) + count(*),
       (SELECT count(DISTINCT id) FROM e) + count(*) FROM region
"""


def run_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Records a whole run writes per entity, after an earlier run has left listings."""
    folder, given = _folder(spark), _responses(spark, sf)
    append_run(_seen_listings(spark, sf), folder, "properties", "20240101_000000")
    written = ingest.ingest(
        spark, folder, "20240102_000000", _listing_pages(spark, sf), given["quick_filter"], given["details"], given["history"], given["charts"])
    return spark.createDataFrame(list(written.items()), "entity string, records long")




def stream_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The streaming job after each of two runs."""
    folder = _folder(spark)
    for run_id, records in _runs(spark, sf):
        append_run(records, folder, "events", run_id)
        query = new_records_query(
            spark, run_glob(folder, "events"), _EVENT, f"{folder}/stored", f"{folder}/progress", "id", ["event_id"]
        )
        query.awaitTermination()
    return read_new_records(spark, f"{folder}/stored", _EVENT).select("id", "event_id", "value")


STREAM_NEW_ROWS = """
WITH e AS (SELECT *, user_id || '/' || CAST(floor(value) AS BIGINT) AS id, event_type <> 'purchase' AS late FROM events)
SELECT id, arg_min(event_id, (late, event_id)) AS event_id, arg_min(value, (late, event_id)) AS value FROM e GROUP BY id
"""

RUN_COUNTS = f"""
SELECT 'properties' AS entity, count(*) AS records FROM ({NEW_PROPERTIES}) AS p
UNION ALL SELECT 'rejected_pages', count(*) FROM pages WHERE (page_id + 1) % 6 = 4
UNION ALL SELECT 'projects', count(*) FROM ({PROJECTS}) AS p
UNION ALL SELECT 'subdivisions', count(*) FROM ({SUBDIVISIONS}) AS p
UNION ALL SELECT 'project_prices', count(*) FROM ({PROJECT_PRICES.replace("s_nationkey <> 20 AND ", "")}) AS p
"""

CHECKS = {
    "q_run_counts": Check(run_counts, RUN_COUNTS),
    "bronze_properties": Check(new_properties, NEW_PROPERTIES),
    "bronze_projects": Check(projects, PROJECTS),
    "bronze_subdivisions": Check(subdivisions, SUBDIVISIONS),
    "bronze_project_prices": Check(project_prices, PROJECT_PRICES),
    "q_run_files": Check(run_files, RUN_FILES),
    "q_stream_new_rows": Check(stream_new_rows, STREAM_NEW_ROWS),
}
