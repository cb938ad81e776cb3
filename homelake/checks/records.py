"""Nested records, embedded JSON, identifiers and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homelake import operators as op
from homelake.checks.common import Check, table
from homelake.plans import silver
from homelake.sources import drop_keys, extract_embedded_json
from homelake.sources.readers import distinct_keys


def explode_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Orders read as projects: many per customer, so the amenity dedupe has work to do."""

    def attribute(identifier, name):
        return F.struct(identifier.cast("string").alias("id"), name.alias("name"))

    key, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    both = F.array(attribute(key, priority), attribute(key + 1_000_000, F.nullif(status, F.lit("O"))))
    attributes = (
        F.when(status == "P", F.lit(None)).when(priority == "1-URGENT", F.array().cast(both_type())).otherwise(both)
    )

    def index(identifier, code, parent, attrs):
        return F.struct(
            identifier.alias("id"), F.concat(F.lit("index "), priority).alias("name"), code.alias("code"),
            parent.alias("parent_type"), attrs.alias("attributes"),
        )

    indexes = F.array(
        index(F.concat(F.lit("a"), key), F.nullif(priority, F.lit("5-LOW")), F.lit("PROJECT"), attributes),
        index(F.concat(F.lit("b"), key), status, F.when(status == "F", "PROJECT").otherwise("SECTOR"), both),
    )
    raw = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("id"),
        F.when(F.col("o_totalprice") > 20000, indexes).alias("quality_indexes"),
    )
    return silver.project_amenities(raw)


def both_type() -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())]))


EXPLODE_NESTED = """
WITH items AS (
  SELECT CAST(o_custkey AS VARCHAR) AS project_id, 'a' || o_orderkey AS amenity_id, 'index ' || o_orderpriority AS amenity_name,
         nullif(o_orderpriority, '5-LOW') AS amenity_code
  FROM orders WHERE o_totalprice > 20000 AND (o_orderstatus = 'P' OR o_orderpriority = '1-URGENT')
  UNION ALL
  SELECT CAST(o_custkey AS VARCHAR), CAST(o_orderkey + n AS VARCHAR),
         CASE WHEN n = 0 THEN o_orderpriority WHEN o_orderstatus = 'O' THEN 'index ' || o_orderpriority ELSE o_orderstatus END,
         nullif(o_orderpriority, '5-LOW')
  FROM orders, (VALUES (0), (1000000)) AS shift(n)
  WHERE o_totalprice > 20000 AND o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT'
  UNION ALL
  SELECT CAST(o_custkey AS VARCHAR), CAST(o_orderkey + n AS VARCHAR),
         CASE WHEN n = 0 THEN o_orderpriority ELSE o_orderstatus END, o_orderstatus
  FROM orders, (VALUES (0), (1000000)) AS shift(n) WHERE o_totalprice > 20000 AND o_orderstatus = 'F')
SELECT project_id, arg_min(amenity_id, (amenity_id, amenity_name)) AS amenity_id,
       arg_min(amenity_name, (amenity_id, amenity_name)) AS amenity_name, amenity_code
FROM items GROUP BY project_id, amenity_code
"""


def explode_series(spark: SparkSession, sf: str) -> DataFrame:
    size, price = F.col("p_size").cast("double"), F.col("p_retailprice")

    def point(month, year, value, percent):
        return F.struct(month.alias("unit"), year.alias("year"), value.alias("price_average"), percent.alias("percent"))

    points = F.array(
        point(size / 4, size + 1990, price, F.lit(0.5)),
        point(F.nullif(size, F.lit(7.0)), F.lit(2020.0), price * 2, F.nullif(size, F.lit(9.0))),
    )
    history = (
        F.when(size > 40, F.lit(None))
        .when(size > 35, F.struct(F.slice(points, 1, 0).alias("value")))
        .otherwise(F.struct(points.alias("value")))
    )
    return silver.project_prices(table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("project_id"), history.alias("price_history")
    ))


EXPLODE_SERIES = """
SELECT CAST(p_partkey AS VARCHAR) AS project_id, CAST(p_size / 4 AS INTEGER) AS month, p_size + 1990 AS year,
       p_retailprice AS price_average, CAST(0.5 AS DOUBLE) AS percent_change FROM part WHERE p_size <= 35
UNION ALL
SELECT CAST(p_partkey AS VARCHAR), nullif(p_size, 7), 2020, p_retailprice * 2, CAST(nullif(p_size, 9) AS DOUBLE)
FROM part WHERE p_size <= 35
"""


def flatten_struct(spark: SparkSession, sf: str) -> DataFrame:
    shape = "k double, list array<double>, deep struct<name:string>"
    props = F.concat(
        F.substring_index("props", "}", 1), F.lit(', "list": ['), "user_id", F.lit(', 2.5], "deep": {"name": "'),
        "event_type", F.lit('"}, "unread": {"x": 1}}'),
    )
    rows = table(spark, sf, "events").select("event_id", F.from_json(props, shape).alias("p"))
    return op.project_spec(rows, [
        op.Out("id", "text", "event_id"),
        op.Out("k", "long", "p.k"),
        op.Out("first", "double", "p.list", 1),
        op.Out("second", "int", "p.list", 2),
        op.Out("third", "double", "p.list", 3),
        op.Out("name", source="p.deep.name"),
    ])


FLATTEN_STRUCT = """
SELECT CAST(event_id AS VARCHAR) AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(user_id AS DOUBLE) AS first,
       2 AS second, CAST(NULL AS DOUBLE) AS third, event_type AS name
FROM events
"""


def history_ids(spark: SparkSession, sf: str) -> DataFrame:
    seen = table(spark, sf, "events").withColumn("id", F.nullif("user_id", F.lit(8)).cast("string"))
    return distinct_keys(seen, "id")


HISTORY_IDS = "SELECT DISTINCT CAST(user_id AS VARCHAR) AS id FROM events WHERE user_id <> 8"


def target_ids(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = table(spark, sf, "supplier").select(
        F.nullif("s_suppkey", F.lit(5)).alias("id"), F.col("s_name").alias("object_code")
    )
    customers = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_custkey")).alias("id"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("")).alias("object_code"),
        F.col("c_nationkey").alias("sector_id"),
    )
    visited = table(spark, sf, "nation").where(F.col("n_regionkey") == 1).select(F.col("n_nationkey").alias("project_id"))
    sources = [(suppliers, ["id", "object_code"]), (customers, ["id", "object_code", "sector_id"])]
    # Identifiers from JSON records: the text "0" is one, the numbers 0 and false are none.
    documents = table(spark, sf, "region").select(F.explode(F.array(
        F.lit('{"id": "0"}'), F.lit('{"id": 0, "object_code": "unused"}'), F.lit('{"id": false}'), F.lit('{"id": -0.0}'), F.lit('{"id": "false"}'),
        F.concat(F.lit('{"object_code": "r'), "r_regionkey", F.lit('"}')))).alias("record"))
    coded = documents.select(op.json_key(F.col("record"), "id").alias("id"), op.json_key(F.col("record"), "object_code").alias("object_code"))
    return op.collect_keys([*sources, (coded, ["id", "object_code"])], visited, "project_id")


TARGET_IDS = """
SELECT DISTINCT project_id FROM (
  SELECT CASE WHEN s_suppkey = 5 THEN s_name ELSE CAST(s_suppkey AS VARCHAR) END AS project_id FROM supplier
  UNION ALL
  SELECT CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey ELSE c_nationkey END AS VARCHAR)
  FROM customer WHERE c_mktsegment = 'BUILDING' OR (c_mktsegment <> 'MACHINERY' AND c_nationkey <> 0)
  UNION ALL SELECT 'r' || r_regionkey FROM region UNION ALL SELECT '0' UNION ALL SELECT 'false')
WHERE project_id NOT IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation WHERE n_regionkey = 1)
"""


def fallback_detail(spark: SparkSession, sf: str) -> DataFrame:
    base = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("price"),
        F.col("c_mktsegment").alias("segment"),
    )
    finished = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    detail = op.latest_per_key(finished, ["o_custkey"], ["o_orderkey"]).select(
        F.col("o_custkey").alias("id"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("name"),
        F.col("o_totalprice").alias("price"), F.col("o_orderkey").alias("order_key"),
    )
    return op.with_fallback(base, detail, "id", ["name", "segment"])


FALLBACK_DETAIL = """
WITH detail AS (
  SELECT o_custkey, max(o_orderkey) AS k, arg_max(nullif(o_orderpriority, '5-LOW'), o_orderkey) AS unused,
         arg_max(o_totalprice, o_orderkey) AS price, arg_max(o_orderpriority, o_orderkey) AS priority
  FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
SELECT c_custkey AS id, CASE WHEN k IS NULL THEN c_name ELSE nullif(priority, '5-LOW') END AS name,
       CASE WHEN k IS NULL THEN c_acctbal ELSE price END AS price, CASE WHEN k IS NULL THEN c_mktsegment END AS segment,
       k AS order_key
FROM customer LEFT JOIN detail ON c_custkey = o_custkey
"""

_SCRIPTS = {
    0: '{"z": {"data": [%(item)s, {"id": "second", "name": null}]}, "a": {"data": {"items": [%(item)s, 7]}}, "n": 5}',
    1: '{"x": {"data": {"items": {"id": 1}}}, "y": {"data": "text"}, "w": [1], "v": {"other": [%(item)s]}}',
    2: '{"q": {"data": []}, "r": {"data": [%(item)s]}}',
    6: '{"z": {"data": 1}, "z": {"data": [%(item)s]}}',
    7: '{"m": NaN, "r": {"data": [%(item)s]}}',
}


def html_json_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with a data script put in: by page number with lists and items, no lists, an empty list, broken JSON,
    another script id, none, a repeated key, NaN, and a script in a comment."""
    item = F.concat(
        F.lit('{"id": '), "page_id", F.lit(', "name": "n'), "page_id", F.lit('", "urls": [1, 2], "images": {"a": 1}, "p": 2.50}')
    )

    def script(tag: str, body):
        return F.concat(F.lit(tag + '{"props": {"pageProps": {"fallback": '), body, F.lit("}}}</script>"))

    def filled(template: str):
        pieces = template.split("%(item)s")
        parts = [F.lit(pieces[0])]
        for piece in pieces[1:]:
            parts += [item, F.lit(piece)]
        return F.concat(*parts)

    kind = F.pmod("page_id", F.lit(9))
    added = (
        F.when(kind == 0, script('<script id="__NEXT_DATA__" type="application/json">', filled(_SCRIPTS[0])))
        .when(kind == 1, script("<script type='application/json' id='__NEXT_DATA__'>", filled(_SCRIPTS[1])))
        .when(kind == 2, script('<SCRIPT\ncrossorigin ID = "__NEXT_DATA__" >', filled(_SCRIPTS[2])))
        .when(kind == 3, F.concat(F.lit('<script id="__NEXT_DATA__">{"props": {"pageProps": {"fallback": '), item, F.lit("</script>")))
        .when(kind == 4, script('<script id="__OTHER_DATA__" data-id="__NEXT_DATA__">', filled(_SCRIPTS[2])))
        .when(kind == 6, script('<script id="__NEXT_DATA__">', filled(_SCRIPTS[6])))
        .when(kind == 7, script('<script id="__NEXT_DATA__">', filled(_SCRIPTS[7])))
        .when(kind == 8, F.concat(
            script('<!-- <script id="__NEXT_DATA__">', filled(_SCRIPTS[0])), F.lit(" -->"), script('<script id="__NEXT_DATA__">', filled(_SCRIPTS[2]))))
        .otherwise("")
    )
    pages = table(spark, sf, "pages").select("page_id", F.concat("html", added).alias("html"))
    records = extract_embedded_json(pages, "page_id", "html")
    return records.select("page_id", "entry_pos", "item_pos", "record")


HTML_JSON_EXTRACT = """
WITH item AS (SELECT page_id, '{"id":' || page_id || ',"name":"n' || page_id || '","p":2.5}' AS record FROM pages)
SELECT page_id, 0 AS entry_pos, 0 AS item_pos, record FROM item WHERE page_id % 9 IN (0, 6)
UNION ALL SELECT page_id, 0, 1, '{"id":"second","name":null}' FROM item WHERE page_id % 9 = 0
UNION ALL SELECT page_id, 1, 0, record FROM item WHERE page_id % 9 IN (0, 2, 7, 8)
"""


def drop_keys_check(spark: SparkSession, sf: str) -> DataFrame:
    props = F.concat(
        F.lit('{"urls": [1], "t": "'), "event_type", F.lit('", "images": {"a": [{"b": 1}]}, '), F.substring("props", 2, 1000)
    )
    return table(spark, sf, "events").select("event_id", drop_keys(props, ["urls", "images", "none"]).alias("record"))


DROP_KEYS = """
SELECT event_id, '{"t":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}' AS record FROM events
"""


def json_profile(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    extra = (
        F.when(kind == "click", ', "list": [1, 2], "deep": {"a": 1}}').when(kind == "view", ', "list": [], "name": "x"}')
        .when(kind == "error", ', "list": ["a"], "name": null, "ok": true}').when(kind == "purchase", ', "k2": 1.5} broken')
        .otherwise(', "name": 3}')
    )
    props = F.concat(F.substring_index("props", "}", 1), extra)
    return op.json_profile(table(spark, sf, "events").select(props.alias("props")), "props")


JSON_PROFILE = """
WITH e AS (SELECT event_type AS t FROM events WHERE event_type <> 'purchase')
SELECT 'k' AS key, 'whole' AS type, count(*) AS records FROM e HAVING count(*) > 0
UNION ALL SELECT 'list', 'list[whole]', count(*) FROM e WHERE t = 'click' HAVING count(*) > 0
UNION ALL SELECT 'deep', 'object', count(*) FROM e WHERE t = 'click' HAVING count(*) > 0
UNION ALL SELECT 'list', 'list', count(*) FROM e WHERE t = 'view' HAVING count(*) > 0
UNION ALL SELECT 'name', 'text', count(*) FROM e WHERE t = 'view' HAVING count(*) > 0
UNION ALL SELECT 'list', 'list[text]', count(*) FROM e WHERE t = 'error' HAVING count(*) > 0
UNION ALL SELECT 'name', 'null', count(*) FROM e WHERE t = 'error' HAVING count(*) > 0
UNION ALL SELECT 'ok', 'flag', count(*) FROM e WHERE t = 'error' HAVING count(*) > 0
UNION ALL SELECT 'name', 'whole', count(*) FROM e WHERE t NOT IN ('click', 'view', 'error') HAVING count(*) > 0
"""


def table_profile(spark: SparkSession, sf: str) -> DataFrame:
    supplier = table(spark, sf, "supplier").withColumn("s_nationkey", F.nullif("s_nationkey", F.lit(3)))
    return op.table_profile(supplier)


TABLE_PROFILE = """
SELECT 0 AS position, 's_suppkey' AS column_name, 'bigint' AS column_type, count(*) AS row_count,
       count(*) - count(s_suppkey) AS null_count FROM supplier
UNION ALL SELECT 1, 's_name', 'string', count(*), count(*) - count(s_name) FROM supplier
UNION ALL SELECT 2, 's_nationkey', 'int', count(*), count(*) - count(nullif(s_nationkey, 3)) FROM supplier
UNION ALL SELECT 3, 's_acctbal', 'double', count(*), count(*) - count(s_acctbal) FROM supplier
"""

CHECKS = {
    "q_explode_nested": Check(explode_nested, EXPLODE_NESTED),
    "q_explode_series": Check(explode_series, EXPLODE_SERIES),
    "q_flatten_struct": Check(flatten_struct, FLATTEN_STRUCT),
    "q_history_ids": Check(history_ids, HISTORY_IDS),
    "q_target_ids": Check(target_ids, TARGET_IDS),
    "q_fallback_detail": Check(fallback_detail, FALLBACK_DETAIL),
    "q_html_json_extract": Check(html_json_extract, HTML_JSON_EXTRACT),
    "q_drop_keys": Check(drop_keys_check, DROP_KEYS),
    "q_json_profile": Check(json_profile, JSON_PROFILE),
    "q_table_profile": Check(table_profile, TABLE_PROFILE),
}
