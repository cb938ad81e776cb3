"""Column functions and row filters."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homelake import functions as fn
from homelake import operators as op
from homelake.checks.common import Check, steadied, table
from homelake.plans import features as ft


def array_join(spark: SparkSession, sf: str) -> DataFrame:
    lines = F.transform(F.split("text", "\\."), lambda part: F.nullif(part, F.lit("")))
    items = F.when(F.col("role") != "system", lines)
    return table(spark, sf, "conversations").select("conv_id", "turn", fn.joined(items).alias("lines"))


ARRAY_JOIN = """
SELECT conv_id, turn, CASE WHEN role <> 'system'
  THEN array_to_string(list_transform(string_split(text, '.'), lambda part: nullif(part, '')), ', ') END AS lines
FROM conversations
"""


def array_index(spark: SparkSession, sf: str) -> DataFrame:
    words = F.split("p_name", " ")
    return table(spark, sf, "part").select("p_partkey", *[fn.nth(words, i).alias(f"word_{i}") for i in (1, 2, 3)])


ARRAY_INDEX = """
SELECT p_partkey, string_split(p_name, ' ')[1] AS word_1, string_split(p_name, ' ')[2] AS word_2,
       string_split(p_name, ' ')[3] AS word_3
FROM part
"""


def round_cast(spark: SparkSession, sf: str) -> DataFrame:
    half = F.col("l_quantity") / 2
    return op.summary_by(
        table(spark, sf, "lineitem").withColumns({"whole": fn.round_to(half, "bigint"), "small": fn.round_to(-half, "int")}),
        ["l_quantity", "whole", "small"],
        {"rows": F.count(F.lit(1))},
    )


ROUND_CAST = """
SELECT l_quantity, CAST(l_quantity / 2 AS BIGINT) AS whole, CAST(-l_quantity / 2 AS INTEGER) AS small, count(*) AS rows
FROM lineitem GROUP BY ALL
"""

_MIXED = """
CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
     WHEN o_orderpriority = '1-URGENT' THEN {day}
     WHEN o_orderpriority = '2-HIGH' THEN {day} || 'T10:00:00Z'
     WHEN o_orderpriority = '3-MEDIUM' THEN CAST(year(o_orderdate) AS {text})
     WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN {day} || ' garbage'
     WHEN o_orderstatus = 'O' AND o_orderkey % 4 = 0 THEN {day} || 'Tgarbage'
     WHEN o_orderstatus = 'O' AND o_orderkey % 4 = 1 THEN {day} || ' 10:30'
     WHEN o_orderstatus = 'O' AND o_orderkey % 4 = 2 THEN {day} || 'T10:00:00.25+07:00 '
     WHEN o_orderstatus = 'F' THEN year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(o_orderdate)
     ELSE substr({day}, 1, 7) END
"""
_SPARK_MIXED = _MIXED.format(day="date_format(o_orderdate, 'yyyy-MM-dd')", text="STRING")
_DUCK_MIXED = _MIXED.format(day="strftime(o_orderdate, '%Y-%m-%d')", text="VARCHAR")


def try_cast_date(spark: SparkSession, sf: str) -> DataFrame:
    mixed = table(spark, sf, "orders").select("o_orderkey", F.expr(_SPARK_MIXED).alias("text"))
    return mixed.withColumn("day", fn.lenient_date(F.col("text")))


TRY_CAST_DATE = f"""
SELECT o_orderkey, text, try_cast(text AS DATE) AS day FROM (SELECT o_orderkey, {_DUCK_MIXED} AS text FROM orders)
"""


def epoch_format(spark: SparkSession, sf: str) -> DataFrame:
    millis = F.unix_millis(F.col("o_orderdate").cast("timestamp")) + F.col("o_custkey") * 1000
    return table(spark, sf, "orders").select("o_orderkey", fn.epoch_day_text(millis).alias("day"))


EPOCH_FORMAT = """
SELECT o_orderkey, strftime(make_timestamp_ms(epoch_ms(o_orderdate) + o_custkey * 1000), '%d-%m-%Y') AS day FROM orders
"""


def title_case(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(F.lit("  "), F.translate("p_name", " e", "-3"), F.lit(" đÔNG o'ến "), "p_type", F.lit("\t"))
    return table(spark, sf, "part").select("p_partkey", fn.title_case(fn.trim_unicode(raw)).alias("title"))


_DUCK_TITLE = (
    r"list_reduce(list_transform(regexp_extract_all({0}, '[\p{{Lu}}\p{{Ll}}\p{{Lt}}]+|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+'),"
    r" lambda w: upper(w[1]) || lower(w[2:])), lambda a, b: a || b)"
)
TITLE_CASE = f"""
SELECT p_partkey, {_DUCK_TITLE.format("raw")} AS title
FROM (SELECT p_partkey, translate(p_name, ' e', '-3') || ' đÔNG o''ến ' || p_type AS raw FROM part)
"""


def typo_fix(spark: SparkSession, sf: str) -> DataFrame:
    return fn.fix_text(table(spark, sf, "part"), {"ring": "rings", "Brand#1": "Brand No. 1", "ECONOMY": "Economy"})


TYPO_FIX = """
SELECT p_partkey, replace(p_name, 'ring', 'rings') AS p_name, replace(p_brand, 'Brand#1', 'Brand No. 1') AS p_brand,
       replace(p_type, 'ECONOMY', 'Economy') AS p_type, p_size, p_retailprice
FROM part
"""

# Raw view texts, composed and decomposed, that together touch every rule.
VIEW_TEXTS = [
    "Ngoại khu (Hồ bơi)", unicodedata.normalize("NFD", "Ngoại khu (Hồ bơi)"), "nghĩa trang, công viên", "K", "k, k",
    "đất trống, đất trống", "nôi khu", "NỘII KHU", "   ", "Thành phố, công viên", "trường học",
    unicodedata.normalize("NFD", "Biển, Núi, biển"), "ngoại khu (đường) , ngoại khu (sông)", "?!", "Khu Mộ", "hướng đông-nam 2a",
]


def categorize_text(spark: SparkSession, sf: str) -> DataFrame:
    texts = F.array(*[F.lit(text) for text in VIEW_TEXTS])
    pick = F.get(texts, F.pmod(F.col("event_id"), F.lit(len(VIEW_TEXTS))).cast("int"))
    suffix = F.concat(F.lit(" , "), F.upper("event_type"), F.lit(", "), "event_type", F.lit(" x"), "user_id")
    noisy = F.when(F.col("value") > 30, F.concat(pick, suffix)).when(F.col("value") > 1, pick)
    events = table(spark, sf, "events").select("event_id", noisy.alias("views"))
    return fn.with_view_category(events, "views", "category").select("event_id", "category")


CATEGORIZE_TEXT = r"""
WITH raw AS (
  SELECT event_id, CASE WHEN value > 30 THEN pick || ' , ' || upper(event_type) || ', ' || event_type || ' x' || user_id
                        WHEN value > 1 THEN pick END AS views
  FROM (SELECT *, ({texts})[event_id % {n} + 1] AS pick FROM events)),
clean AS (
  SELECT event_id, views, regexp_replace(replace(replace(trim(lower(nfc_normalize(views))), 'nôi khu', 'nội khu'),
         'nộii khu', 'nội khu'), 'ngoại khu\s*\((.*?)\)', '\1', 'g') AS v FROM raw),
tokens AS (
  SELECT *, regexp_replace(v, '[^\p{{L}}\p{{N}}_]', '', 'g') AS w,
         list_filter(list_transform(string_split(v, ','), lambda x: trim(x)), lambda x: x <> '') AS t FROM clean),
kept AS (
  SELECT *, array_to_string(list_filter(t, lambda x, i: list_position(t, x) = i), ', ') AS u FROM tokens)
SELECT event_id, CASE
  WHEN views IS NULL OR trim(views) = '' THEN 'Không Xác Định'
  WHEN v LIKE '%nghĩa trang%' OR v LIKE '%khu mộ%' THEN 'Nghĩa Trang / Khu Mộ'
  WHEN length(w) <= 1 OR trim(w, 'k') = '' THEN 'Khác'
  WHEN v LIKE '%hồ%' THEN 'Hồ' WHEN v LIKE '%công viên%' THEN 'Công Viên' WHEN v LIKE '%thành phố%' THEN 'Thành Phố'
  WHEN v LIKE '%trường học%' THEN 'Trường Học' WHEN v LIKE '%nội khu%' THEN 'Nội Khu'
  ELSE {title} END AS category
FROM kept
""".format(texts="[" + ", ".join(f"'{text}'" for text in VIEW_TEXTS) + "]", n=len(VIEW_TEXTS), title=_DUCK_TITLE.format("u"))


def token_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", fn.dedupe_tokens(F.col("text")).alias("tokens"))


TOKEN_DEDUPE = r"""
WITH pieces AS (
  SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos
  FROM (SELECT doc_id, list_transform(string_split(text, ','), lambda x: regexp_replace(x, '^[\s\pZ]+|[\s\pZ]+$', '', 'g')) AS t
        FROM documents)),
firsts AS (SELECT doc_id, token, min(pos) AS pos FROM pieces WHERE token <> '' GROUP BY ALL)
SELECT doc_id, coalesce(string_agg(token, ', ' ORDER BY pos), '') AS tokens
FROM (SELECT doc_id FROM documents) LEFT JOIN firsts USING (doc_id) GROUP BY doc_id
"""


def dropna(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise(F.col("o_orderpriority")).alias("views"),
        F.when(F.col("o_totalprice") > 400000, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("price"),
    )
    return orders.dropna(subset=["status", "views", "price"])


DROPNA = """
SELECT o_orderkey, o_orderstatus AS status, CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE o_orderpriority END AS views,
       o_totalprice AS price
FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice <= 400000
"""


def not_contains(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").withColumn("name", F.nullif(F.upper("p_name"), F.lit("SMALL RING")))
    return parts.where(op.not_containing(F.col("name"), "ring")).select("p_partkey", "name")


NOT_CONTAINS = """
SELECT p_partkey, nullif(upper(p_name), 'SMALL RING') AS name FROM part
WHERE p_name = 'small ring' OR p_name NOT LIKE '%ring%'
"""

_DIRECTIONS = {"ECONOMY": "Đông Nam", "SMALL": "TÂY BẮC", "PROMO": "Nam", "STANDARD": "bắc"}
_DUCK_DIRECTIONS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _DIRECTIONS.items())


def features_basic(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    parts = table(spark, sf, "part").select(
        "p_partkey",
        F.when(size <= 6, size - 1).when(size > 8, size).cast("double").alias("bedrooms"),
        fn.encode(F.col("p_type"), _DIRECTIONS, None).alias("directions"),
        F.when(size < 10, "Căn hộ CAO CẤP").when(size < 20, "Trung Cấp").when(size < 30, "khác").alias("rank"),
        F.when(size < 10, "SECONDARY").when(size < 20, "SECONDARY, PRIMARY").when(size < 30, "primary").alias("demand"),
        F.when(size < 10, "Cơ bản").when(size < 20, "ĐẦY ĐỦ").when(size < 30, "bàn giao thô").when(size < 40, "lạ")
        .alias("furniture"),
        F.col("p_name").alias("views"),
    )
    secondary, primary = ft.demand_flags(F.col("demand"))
    return parts.select(
        "p_partkey",
        ft.bedroom_class(F.col("bedrooms")).alias("bedroom_count"),
        ft.main_direction(F.col("directions")).alias("window_direction"),
        ft.rank_class(F.col("rank")).alias("rank"),
        secondary.alias("is_secondary_only"),
        primary.alias("has_primary"),
        ft.furniture_code(F.col("furniture")).alias("furniture_status_encoded"),
        F.col("views").alias("view_type"),
    )


FEATURES_BASIC = f"""
SELECT p_partkey,
  CASE WHEN p_size IN (7, 8) THEN 'Unknown' WHEN p_size = 1 THEN 'Studio' WHEN p_size IN (2, 3) THEN '1-2PN'
       WHEN p_size = 4 THEN '3PN' ELSE 'Oversized' END AS bedroom_count,
  CASE p_type WHEN 'ECONOMY' THEN 'Đông' WHEN 'SMALL' THEN 'Tây' WHEN 'PROMO' THEN 'Nam' WHEN 'STANDARD' THEN 'Bắc'
       ELSE 'Khác' END AS window_direction,
  CASE WHEN p_size < 10 THEN 'Cao cấp' WHEN p_size < 20 THEN 'Trung cấp' ELSE 'Bình dân' END AS rank,
  CAST(p_size < 10 AS INTEGER) AS is_secondary_only,
  CAST(p_size BETWEEN 10 AND 19 AS INTEGER) AS has_primary,
  CAST(CASE WHEN p_size < 10 THEN 1 WHEN p_size < 20 THEN 3 WHEN p_size < 30 THEN 0 ELSE 1 END AS DOUBLE)
    AS furniture_status_encoded,
  p_name AS view_type
FROM part
"""


def features_ratio(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax",
        F.when(F.col("l_returnflag") != "R", F.col("l_discount")).alias("divisor"),
    )
    result = lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax", "divisor",
        fn.safe_div(F.col("l_quantity"), F.col("divisor")).alias("bathroom_per_sqm"),
        (F.col("l_tax") * F.col("divisor")).alias("density_vs_location"),
        ft.boutique_index(F.col("l_tax"), F.col("divisor")).alias("boutique_index"),
    )
    return steadied(result, "bathroom_per_sqm", "density_vs_location", "boutique_index")


FEATURES_RATIO = """
WITH lines AS (SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_discount END AS divisor FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_tax, divisor,
       round(l_quantity / nullif(divisor, 0) + 1e-7, 4) AS bathroom_per_sqm,
       round(l_tax * divisor + 1e-7, 4) AS density_vs_location,
       round(CASE WHEN l_tax / nullif(divisor, 0) > 0 THEN 1 / (l_tax / nullif(divisor, 0)) ELSE 0 END + 1e-7, 4)
         AS boutique_index
FROM lines
"""


def features_flags(spark: SparkSession, sf: str) -> DataFrame:
    size, name = F.col("p_size"), F.col("p_name")
    kinds = F.when(name.contains("ring"), "Biệt Thự").when(name.contains("bolt"), "nhà, VILLA").when(
        name.contains("widget"), "Shophouse, Officetel").when(name.contains("gear"), "Căn hộ")
    parts = table(spark, sf, "part").select(
        "p_partkey",
        F.when(size < 30, F.concat(F.lit("Tầng "), F.translate("p_brand", "Brand#", ""), F.lit("A")))
        .when(size < 40, "Thấp").alias("floor_number"),
        kinds.alias("property_type"),
        F.when(name.startswith("red"), "Căn GÓC").when(name.startswith("blue"), "giữa").alias("positions"),
        (F.col("p_retailprice") * 150_000).alias("min_unit_price"),
        (size * 5.0).alias("min_area"),
        F.when(size < 20, "Nghĩa Trang / Khu Mộ").when(size < 40, "Hồ").alias("views"),
        F.when(size < 10, "cao cấp").when(size < 15, "trung cấp").alias("rank"),
        F.when(size < 10, "Yes").when(size < 20, "no").alias("local_bus"),
        F.when(size.between(5, 12), "YES").alias("central_bus"),
        F.lit(None).cast("double").alias("number_of_bedrooms"),
        F.lit("").alias("demand_code"), F.lit("").alias("directions"), F.lit("").alias("furniture_status"),
        F.lit("").alias("infra_grade"), F.lit(0.0).alias("number_of_bathrooms"), F.lit(0.0).alias("cstn_dens"),
        F.lit(0.0).alias("center_rd_dist"), F.lit(0).alias("max_prop_per_floor"), F.lit(0.0).alias("number_ele_max"),
        (size * 6.0).alias("max_area"),
    )
    first, second = ft.derived_features()
    return parts.withColumns(first).withColumns(second).select(
        "p_partkey", "is_corner", "area_discount_ratio", "floor_num", "is_special_low_floor",
        "cemetery_penalty_interaction", "premium_transit_flag", "commercial_area_multiplier", "ultra_luxury_isolate",
        "micro_investment_flag",
    )


FEATURES_FLAGS = """
SELECT p_partkey,
  CAST(p_name LIKE 'red%' AS INTEGER) AS is_corner,
  CASE WHEN p_name LIKE 'red%' THEN p_size * 6.0::DOUBLE ELSE 0.0 END AS area_discount_ratio,
  CASE WHEN p_size < 30 THEN CAST(replace(p_brand, 'Brand#', '') AS DOUBLE) END AS floor_num,
  CAST(p_size < 30 AND CAST(replace(p_brand, 'Brand#', '') AS INTEGER) <= 10 AND p_retailprice * 150000 > 150000000
       AS INTEGER) AS is_special_low_floor,
  CASE WHEN p_size < 10 THEN 3 WHEN p_size < 15 THEN 2 WHEN p_size < 20 THEN 1 ELSE 0 END
    AS cemetery_penalty_interaction,
  CAST(p_size < 10 OR p_size BETWEEN 5 AND 12 AS INTEGER) AS premium_transit_flag,
  CASE WHEN p_name LIKE '%widget%' THEN p_size * 5.0::DOUBLE ELSE 0.0 END AS commercial_area_multiplier,
  CAST((p_name LIKE '%ring%' OR p_name LIKE '%bolt%') AND p_size * 5 > 150 AS INTEGER) AS ultra_luxury_isolate,
  CAST(p_name LIKE '%widget%' AS INTEGER) AS micro_investment_flag
FROM part
"""

CHECKS = {
    "q_array_join": Check(array_join, ARRAY_JOIN),
    "q_array_index": Check(array_index, ARRAY_INDEX),
    "q_round_cast": Check(round_cast, ROUND_CAST),
    "q_try_cast_date": Check(try_cast_date, TRY_CAST_DATE),
    "q_epoch_format": Check(epoch_format, EPOCH_FORMAT),
    "q_title_case": Check(title_case, TITLE_CASE),
    "q_typo_fix": Check(typo_fix, TYPO_FIX),
    "q_categorize_text": Check(categorize_text, CATEGORIZE_TEXT),
    "q_token_dedupe": Check(token_dedupe, TOKEN_DEDUPE),
    "q_dropna": Check(dropna, DROPNA),
    "q_not_contains": Check(not_contains, NOT_CONTAINS),
    "q_features_basic": Check(features_basic, FEATURES_BASIC),
    "q_features_ratio": Check(features_ratio, FEATURES_RATIO),
    "q_features_flags": Check(features_flags, FEATURES_FLAGS),
}
