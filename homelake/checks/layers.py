"""The layer builders on listing-shaped records that Spark derives from the test tables.

Order lines become listing records (several versions per id), parts become projects with quality indexes and price
histories, suppliers become subdivisions.  The SQL derives the same silver tables directly.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homelake import schemas
from homelake.checks.common import Check, steadied, table
from homelake.plans import features, gold, silver, states
from homelake.session import cut_lineage, shared_folder
from homelake.sources import read_tables, write_table
from homelake.sources.buckets import read_buckets
from homelake.sources.readers import RUN_ID

# ---- expressions both dialects read the same way -------------------------------------------------------------

LISTING = {
    "id": "CAST(l_orderkey AS STRING)",
    "project_id": "CASE WHEN l_linenumber <> 1 OR l_returnflag <> 'A' THEN CAST(l_partkey AS STRING) END",
    "block_id": "CAST(l_linenumber AS STRING)",
    "sector_id": "CASE WHEN l_linenumber <> 2 THEN CAST(l_suppkey AS STRING) END",
    "sector_name": "CASE WHEN l_quantity > 3 THEN 'Sector ' || (l_suppkey % 50) END",
    "province": "l_returnflag",
    "district": "'D' || (l_suppkey % 10)",
    "ward": "'W' || (l_partkey % 7)",
    "number_of_bedrooms": "CASE WHEN l_linenumber < 7 THEN CAST(l_linenumber - 1 AS DOUBLE) END",
    "min_area": "CASE WHEN l_discount <> 0.1 THEN l_quantity * 2 END",
    "max_area": "l_quantity * 2 + l_linenumber",
    "urgent_sale": "l_discount > 0.05",
    "sell_for_cut_losses": "CASE WHEN l_tax > 0 THEN l_tax > 0.05 END",
    "floor_number": "CASE WHEN l_linenumber <= 4 THEN 'Tầng ' || (l_linenumber * 4) || 'B' WHEN l_linenumber = 5 THEN 'Thấp' END",
}
LISTING_PRICES = {
    "min_selling_price": "CASE WHEN l_tax <> 0.08 THEN l_extendedprice / 4 END",
    "max_selling_price": "l_extendedprice",
    "min_unit_price": "l_extendedprice * 2000",
    "max_unit_price": "l_extendedprice * 2001",
}
LAT, LONG = "l_quantity / 7 + 10", "l_extendedprice / 100000 + 106"
FURNITURE = "CASE l_linenumber WHEN 1 THEN 'Cơ bản' WHEN 2 THEN 'ĐẦY ĐỦ' WHEN 3 THEN 'cao cấp' END"
MODIFIED = "{ms} + l_linenumber * 10000000 + l_partkey * 500"
# Raw views and the category each must get; the last two entries are an empty list and a missing one.
VIEWS = [
    ("array('Hồ bơi', 'nội khu')", "'Hồ'"),
    ("array('nghĩa trang', 'công viên')", "'Nghĩa Trang / Khu Mộ'"),
    ("array('k', 'K')", "'Khác'"),
    ("array('Ngoại khu (đường lớn)', 'đường lớn')", "'Đường Lớn'"),
    ("array('nôi khu')", "'Nội Khu'"),
    ("array('Biển-đảo 2a', NULL, 'biển-đảo 2A')", "'Biển-Đảo 2A'"),
    ("array()", "'Không Xác Định'"),
    ("NULL", "NULL"),
]
TYPES = [("array('Căn hộ', 'Officetel')", "'Căn hộ, Officetel'"), ("array('Shophouse')", "'Shophouse'"),
         ("array('Biệt thự')", "'Biệt thự'"), ("array('Villa', NULL)", "'Villa'"), ("array('Đất')", "'Đất'")]
DIRECTIONS = [("array('Đông Nam', 'Tây')", "'Đông Nam, Tây'"), ("array('bắc')", "'bắc'"), ("array()", "''"), ("NULL", "NULL")]
POSITIONS = [("array('Căn GÓC')", "'Căn GÓC'"), ("array('giữa', 'góc')", "'giữa, góc'"), ("NULL", "NULL")]

PROJECT = {
    "id": "CAST(p_partkey AS STRING)",
    "district": "'D' || (p_partkey % 10)",
    "province": "p_type",
    "developer_name": "CASE WHEN p_size > 5 THEN p_brand END",
    "rank": "CASE WHEN p_size < 10 THEN 'Căn hộ CAO CẤP' WHEN p_size < 20 THEN 'trung cấp' END",
    "local_bus": "CASE WHEN p_size % 3 = 0 THEN 'Yes' WHEN p_size % 3 = 1 THEN 'no' END",
    "central_bus": "CASE WHEN p_size % 5 = 0 THEN 'YES' END",
    "infra_grade": "'grade ' || p_size",
    "cstn_dens": "p_size / CAST(100 AS DOUBLE)",
    "center_rd_dist": "CAST(p_size AS DOUBLE)",
}
HANDOVER = """CASE WHEN p_size < 20 THEN '20' || (10 + p_size) || '-' || (1 + p_size % 9) || '-1' || (p_size % 10)
                   WHEN p_size < 30 THEN '2024' WHEN p_size < 40 THEN '' END"""
DEMAND = [("array('SECONDARY')", "'SECONDARY'"), ("array('SECONDARY', 'PRIMARY')", "'SECONDARY, PRIMARY'"),
          ("array('PRIMARY')", "'PRIMARY'"), ("NULL", "NULL")]


def _choose(selector: str, options: list[tuple[str, str]], side: int) -> str:
    """CASE over the options' left (Spark) or right (SQL) side; the last one is the default."""
    cases = " ".join(f"WHEN {i} THEN {option[side]}" for i, option in enumerate(options[:-1]))
    return f"CASE {selector} {cases} ELSE {options[-1][side]} END"


def _record(df: DataFrame, columns: dict[str, str], schema: T.StructType, extra: dict[str, str] | None = None) -> DataFrame:
    """Columns of a read schema: the given expressions, and nulls for fields the records lack."""
    fields = [F.expr(columns.get(f.name, "NULL")).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*fields, *[F.expr(e).alias(n) for n, e in (extra or {}).items()])


# ---- bronze records ------------------------------------------------------------------------------------------


def raw_properties(spark: SparkSession, sf: str) -> DataFrame:
    columns = {
        **LISTING,
        **LISTING_PRICES,
        "project_name": "'  grand-PARK s' || l_suppkey || 'a '",
        "block_name": "'Block High-quanlity ' || l_linenumber",
        "geolocation": f"CASE WHEN l_linenumber <> 6 THEN named_struct('lat_cdnt', {LAT}, 'long_cdnt', {LONG}) END",
        "property_furnitures": f"named_struct('furniture_status', {FURNITURE})",
        "view_count": "named_struct('count', l_quantity / 2)",
        "last_modified_date": MODIFIED.format(ms="unix_millis(CAST(l_shipdate AS TIMESTAMP))"),
        "number_of_bathrooms": "CASE WHEN l_linenumber < 7 THEN array(CAST(l_linenumber AS DOUBLE), 9D) END",
        "views": _choose("l_partkey % 8", VIEWS, 0),
        "property_type": _choose("l_linenumber - 1", TYPES, 0),
        "directions": _choose("l_linenumber - 1", DIRECTIONS, 0),
        "positions": _choose("l_linenumber - 1", POSITIONS, 0),
    }
    return _record(table(spark, sf, "lineitem"), columns, schemas.PROPERTIES)


def raw_projects(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs; the second holds new versions of half of the projects."""
    columns = {
        **PROJECT,
        "name": "p_name || suffix",
        "handover_date_from": HANDOVER,
        "min_unit_price": "p_retailprice * 1.5",
        "max_unit_price": "p_retailprice * 2.5",
        "number_ele": "CASE WHEN p_size % 6 <> 0 THEN array(2, p_size % 4) ELSE array(3) END",
        "max_prop_per_floor": "p_size / 4",
        "monthly_service_fee": "array(p_retailprice)",
        "demand_code": _choose("p_size % 4", DEMAND, 0),
        "lat_cdnt": "p_retailprice / 100",
    }
    runs = F.explode(F.expr(
        "CASE WHEN p_size % 2 = 0 THEN array(struct('1' AS run, '' AS suffix), struct('2' AS run, ' v2' AS suffix)) "
        "ELSE array(struct('1' AS run, '' AS suffix)) END"
    ))
    versions = table(spark, sf, "part").withColumn("v", runs).select("*", "v.*")
    return _record(versions, columns, schemas.PROJECTS, {RUN_ID: "run"})


def raw_quality(spark: SparkSession, sf: str) -> DataFrame:
    indexes = """array(
      struct('q' || p_partkey AS id, 'Công viên' AS name, 'c' || (p_size % 3) AS code, 'PROJECT' AS parent_type,
        CASE p_size % 3 WHEN 1 THEN array() WHEN 2 THEN
          array(struct('a1' AS id, 'Trạm XE BUÝT' AS name), struct('a2' AS id, 'Hồ' AS name)) END AS attributes),
      struct('r' || p_partkey AS id, 'Vincom' AS name, CASE WHEN p_size % 2 = 1 THEN 'd' END AS code,
        CASE WHEN p_size % 5 = 0 THEN 'SECTOR' ELSE 'PROJECT' END AS parent_type,
        array(struct(NULL AS id, 'Vinmec' AS name), struct('b' AS id, NULL AS name)) AS attributes))"""
    return _record(table(spark, sf, "part"), {"id": PROJECT["id"], "quality_indexes": indexes}, schemas.PROJECT_QUALITY)


def raw_subdivisions(spark: SparkSession, sf: str) -> DataFrame:
    columns = {
        "sector_id": "CAST(s_suppkey AS STRING)",
        "sector_name": "s_name",
        "project_id": "CASE WHEN s_nationkey <> 0 THEN CAST(s_suppkey * 3 AS STRING) END",
        "developer_name": "'dev ' || s_nationkey",
        "min_selling_price": "s_acctbal / 2",
        "min_prop_per_floor": "s_nationkey",
        "max_prop_per_floor": "s_nationkey + 3",
        "number_ele": "array(s_nationkey, 4)",
        "number_living_floor": "s_acctbal / 100",
        "handover_date_to": "'2025-12-31T10:00:00Z'",
    }
    return _record(table(spark, sf, "supplier"), columns, schemas.SUBDIVISIONS)


def raw_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Series of projects, with a repeated month, a missing price and a missing year, and series of subdivisions."""
    points = """array(
      struct(11 AS unit, 2023 AS year, p_retailprice AS price_average, 0.5 AS percent),
      struct(1 AS unit, 2024 AS year, p_retailprice * 2 AS price_average, CAST(p_size AS DOUBLE) AS percent),
      struct(1 AS unit, 2024 AS year, p_retailprice * 3 AS price_average, NULL AS percent),
      struct(2 AS unit, 2024 AS year, NULL AS price_average, 1.0 AS percent),
      struct(3 AS unit, NULL AS year, p_retailprice AS price_average, 0.0 AS percent))"""
    history = f"CASE WHEN p_size > 45 THEN NULL WHEN p_size > 40 THEN struct(NULL AS value) ELSE struct({points} AS value) END"
    of_projects = _record(
        table(spark, sf, "part"), {"project_id": PROJECT["id"], "price_history": history}, schemas.PROJECT_PRICES
    )
    point = "array(struct(11 AS unit, 2023 AS year, s_acctbal AS price_average, 0.0 AS percent))"
    of_sectors = _record(
        table(spark, sf, "supplier"),
        {"project_id": "'s' || s_suppkey", "price_history": f"struct({point} AS value)"},
        schemas.PROJECT_PRICES,
    )
    return of_projects.unionByName(of_sectors)


_BUILDERS = {
    "properties": (silver.properties, raw_properties),
    "projects": (silver.projects, raw_projects),
    "project_amenities": (silver.project_amenities, raw_quality),
    "subdivisions": (silver.subdivisions, raw_subdivisions),
    "project_prices": (silver.project_prices, raw_prices),
}


def silver_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    build, raw = _BUILDERS[name]
    return build(raw(spark, sf))


# ---- the same silver tables in SQL ---------------------------------------------------------------------------

_TYPES = {"text": "VARCHAR", "joined": "VARCHAR", "epoch_day": "VARCHAR", "keep": "VARCHAR", "long": "BIGINT",
          "int": "INTEGER", "double": "DOUBLE", "date": "DATE"}
_FLAGS = {"is_liked", "good_price"}


def _select(spec: list, columns: dict[str, str], source: str) -> str:
    outs = []
    for out in spec:
        kind = "BOOLEAN" if out.name in _FLAGS else _TYPES[out.kind]
        value = columns.get(out.name, "NULL")
        plain = out.kind in ("keep", "joined", "text") and value != "NULL"
        outs.append(f'{value if plain else f"CAST({value} AS {kind})"} AS "{out.name}"')
    return f"SELECT {', '.join(outs)} FROM {source}"


_PROPERTIES = {
    **LISTING,
    **LISTING_PRICES,
    "project_name": "'Grand-Park S' || l_suppkey || 'A'",
    "block_name": "'Block High-quality ' || l_linenumber",
    "lat": f"CASE WHEN l_linenumber <> 6 THEN {LAT} END",
    "long": f"CASE WHEN l_linenumber <> 6 THEN {LONG} END",
    "furniture_status": FURNITURE,
    "view_count": "l_quantity / 2",
    "last_modified_date": "strftime(make_timestamp_ms(modified), '%d-%m-%Y')",
    "number_of_bathrooms": "CASE WHEN l_linenumber < 7 THEN CAST(l_linenumber AS DOUBLE) END",
    "views": _choose("l_partkey % 8", VIEWS, 1),
    "property_type": _choose("l_linenumber - 1", TYPES, 1),
    "directions": _choose("l_linenumber - 1", DIRECTIONS, 1),
    "positions": _choose("l_linenumber - 1", POSITIONS, 1),
}
_PROJECTS = {
    **PROJECT,
    "name": "p_name || CASE WHEN p_size % 2 = 0 THEN ' v2' ELSE '' END",
    "handover_date_from": f"try_cast({HANDOVER} AS DATE)",
    "min_unit_price": "p_retailprice * 1.5",
    "max_unit_price": "p_retailprice * 2.5",
    "number_ele_min": "CASE WHEN p_size % 6 <> 0 THEN 2 ELSE 3 END",
    "number_ele_max": "CASE WHEN p_size % 6 <> 0 THEN p_size % 4 END",
    "max_prop_per_floor": "p_size / 4",
    "monthly_service_fee": "p_retailprice",
    "demand_code": _choose("p_size % 4", DEMAND, 1),
    "lat": "p_retailprice / 100",
}
_SUBDIVISIONS = {
    "id": "CAST(s_suppkey AS STRING)",
    "name": "s_name",
    "project_id": "CASE WHEN s_nationkey <> 0 THEN CAST(s_suppkey * 3 AS STRING) END",
    "developer_name": "'dev ' || s_nationkey",
    "min_selling_price": "s_acctbal / 2",
    "min_prop_per_floor": "s_nationkey",
    "max_prop_per_floor": "s_nationkey + 3",
    "number_ele_min": "s_nationkey",
    "number_ele_max": "4",
    "number_living_floor": "s_acctbal / 100",
    "handover_date_to": "DATE '2025-12-31'",
}
SILVER = f"""
WITH versions AS (SELECT *, {MODIFIED.format(ms="epoch_ms(l_shipdate)")} AS modified FROM lineitem),
newest AS (SELECT versions.* FROM versions
           SEMI JOIN (SELECT l_orderkey, max(modified) AS modified FROM versions GROUP BY l_orderkey) AS m
           USING (l_orderkey, modified)),
properties AS (
  {_select(silver.PROPERTY_COLUMNS, _PROPERTIES, "newest")}
  WHERE l_tax <> 0.08 AND l_discount <> 0.1 AND l_partkey % 8 <> 7),
projects AS ({_select(silver.PROJECT_COLUMNS, _PROJECTS, "part")}),
project_amenities AS (
  SELECT CAST(p_partkey AS VARCHAR) AS project_id, CASE WHEN p_size % 3 = 2 THEN 'a1' ELSE 'q' || p_partkey END AS amenity_id,
         CASE WHEN p_size % 3 = 2 THEN 'Trạm XE BUÝT' ELSE 'Công viên' END AS amenity_name, 'c' || (p_size % 3) AS amenity_code
  FROM part
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), 'b', 'Vincom', CASE WHEN p_size % 2 = 1 THEN 'd' END FROM part WHERE p_size % 5 <> 0),
subdivisions AS ({_select(silver.SUBDIVISION_COLUMNS, _SUBDIVISIONS, "supplier")}),
project_prices AS (
  SELECT CAST(p_partkey AS VARCHAR) AS project_id, CAST(m AS INTEGER) AS month, CAST(y AS INTEGER) AS year,
         CAST(p_retailprice * f AS DOUBLE) AS price_average, CAST(CASE WHEN c = -1 THEN p_size ELSE c END AS DOUBLE) AS percent_change
  FROM part, (VALUES (11, 2023, 1, 0.5), (1, 2024, 2, -1), (1, 2024, 3, NULL), (2, 2024, NULL, 1), (3, NULL, 1, 0)) AS p(m, y, f, c)
  WHERE p_size <= 40
  UNION ALL SELECT 's' || s_suppkey, 11, 2023, s_acctbal, 0.0 FROM supplier)
"""

GOLD = {
    "price_by_ward": """
      SELECT district, ward, count(id) AS total_properties, round(avg(min_selling_price) + 1e-7, 4) AS avg_min_selling_price,
             round(avg(max_selling_price) + 1e-7, 4) AS avg_max_selling_price, min(min_selling_price) AS lowest_price,
             max(max_selling_price) AS highest_price
      FROM properties GROUP BY ALL""",
    "property_summary": """
      SELECT province, district, ward, property_type, count(id) AS total_supply,
             round(avg((min_unit_price + max_unit_price) / 2) + 1e-7, 2) AS avg_unit_price,
             count(*) FILTER (WHERE urgent_sale) AS urgent_sale_count,
             count(*) FILTER (WHERE sell_for_cut_losses) AS cut_loss_count
      FROM properties GROUP BY ALL""",
    "property_area_bins": """
      SELECT province, district, area_bin, count(id) AS total_supply, round(avg(min_selling_price) + 1e-7, 4) AS avg_price
      FROM (SELECT *, (min_area + max_area) / 2 AS mid,
                   CASE WHEN mid < 50 THEN '<50m2' WHEN mid > 80 THEN '>80m2' ELSE '50-80m2' END AS area_bin FROM properties)
      GROUP BY ALL""",
    "price_history_monthly": """
      SELECT district, year, month, round(avg(price_average) + 1e-7, 4) AS avg_price,
             round(avg(percent_change) + 1e-7, 4) AS avg_percent_change
      FROM project_prices JOIN projects ON project_id = id GROUP BY ALL""",
    "developer_pricing": """
      SELECT developer_name, count(id) AS total_projects, round(avg((min_unit_price + max_unit_price) / 2) + 1e-7, 4) AS avg_unit_price,
             min(handover_date_from) AS min_handover_date, max(handover_date_from) AS max_handover_date
      FROM projects WHERE developer_name IS NOT NULL GROUP BY ALL""",
    "project_quality": """
      SELECT id, name, district, (SELECT count(*) FROM project_amenities WHERE project_id = projects.id) AS amenity_count,
             cstn_dens, monthly_service_fee, bike_parking_monthly, car_parking_monthly
      FROM projects""",
    "subdivision_area_boxplot": """
      SELECT sector_name, min(min_area) AS min_carpet_area, max(max_area) AS max_carpet_area,
             median((min_area + max_area) / 2) AS median_carpet_area
      FROM properties WHERE sector_name IS NOT NULL GROUP BY ALL""",
    "subdivision_metrics": """
      SELECT s.id AS subdivision_id, s.name AS subdivision_name, s.project_id, p.name AS project_name, p.district, p.province,
             (s.min_prop_per_floor + s.max_prop_per_floor) / 2 AS avg_prop_per_floor,
             (s.number_ele_min + s.number_ele_max) / 2 AS avg_ele, s.number_living_floor
      FROM subdivisions AS s LEFT JOIN projects AS p ON p.id = s.project_id""",
    "project_handover_timeline": """
      SELECT id AS project_id, name AS project_name, district, province, developer_name, handover_date_from
      FROM projects WHERE handover_date_from IS NOT NULL""",
    "geo_heatmap": """
      SELECT round(lat, 3) AS lat_bin, round(long, 3) AS long_bin, count(id) AS property_count,
             round(avg(min_selling_price) + 1e-7, 4) AS avg_price
      FROM properties WHERE lat IS NOT NULL GROUP BY ALL""",
}
_ROUNDED = {
    "price_by_ward": (4, "avg_min_selling_price", "avg_max_selling_price"),
    "property_summary": (2, "avg_unit_price"),
    "property_area_bins": (4, "avg_price"),
    "price_history_monthly": (4, "avg_price", "avg_percent_change"),
    "developer_pricing": (4, "avg_unit_price"),
    "geo_heatmap": (4, "avg_price"),
}

_PROJECT_KEPT = [o.name for o in silver.PROJECT_COLUMNS if o.name not in [*features.PROJECT_EXCLUDE, "rank", "lat", "long"]]
FEATURES = f"""
, scores AS (
  SELECT project_id, count(DISTINCT amenity_id) AS amenity_score,
         sum(CASE amenity_name WHEN 'Trạm XE BUÝT' THEN 5 WHEN 'Vincom' THEN 4 WHEN 'Công viên' THEN 2 END) AS core
  FROM project_amenities GROUP BY ALL),
monthly AS (
  SELECT project_id, max(price_average) FILTER (WHERE year = 2023 AND month = 11) AS price_2023_11,
         max(price_average) FILTER (WHERE year = 2024 AND month = 1) AS price_2024_01,
         max(price_average) FILTER (WHERE year = 2024 AND month = 2) AS price_2024_02
  FROM project_prices GROUP BY ALL),
spread AS (SELECT sector_id, coalesce(stddev_samp(min_selling_price), 0) AS std FROM properties WHERE sector_id IS NOT NULL GROUP BY ALL),
joined AS (
  SELECT p.*, {", ".join(f'j."{name}"' for name in _PROJECT_KEPT)}, j.lat AS lat_1, j.long AS long_1,
         CASE WHEN j.rank ILIKE '%cao cấp%' THEN 'Cao cấp' WHEN j.rank ILIKE '%trung cấp%' THEN 'Trung cấp' ELSE 'Bình dân' END AS rank,
         coalesce(s.amenity_score, 0) AS amenity_score, CAST(coalesce(s.core, 0) AS BIGINT) AS core_amenity_score,
         price_2023_11, price_2024_01, price_2024_02, coalesce(std, 0) AS std, j.max_prop_per_floor / nullif(j.number_ele_max, 0) AS load,
         CASE WHEN floor_number LIKE '%B' THEN CAST(CAST(block_id AS INTEGER) * 4 AS DOUBLE) END AS floor_num,
         CAST(coalesce(p.property_type LIKE '%Shop%', false) AS INTEGER) AS shop,
         CAST(coalesce(p.positions IS NOT NULL, false) AS INTEGER) AS is_corner
  FROM properties AS p LEFT JOIN projects AS j ON p.project_id = j.id LEFT JOIN scores AS s ON p.project_id = s.project_id
  LEFT JOIN monthly AS m ON p.project_id = m.project_id LEFT JOIN spread AS d ON p.sector_id = d.sector_id),
derived AS (
  SELECT * EXCLUDE (std, load, shop),
    CASE WHEN number_of_bedrooms IS NULL THEN 'Unknown' WHEN number_of_bedrooms = 0 THEN 'Studio' WHEN number_of_bedrooms < 3 THEN '1-2PN'
         WHEN number_of_bedrooms = 3 THEN '3PN' ELSE 'Oversized' END AS bedroom_count,
    CASE directions WHEN 'bắc' THEN 'Bắc' WHEN 'Đông Nam, Tây' THEN 'Đông' ELSE 'Khác' END AS window_direction,
    CAST(coalesce(demand_code = 'SECONDARY', false) AS INTEGER) AS is_secondary_only,
    CAST(coalesce(demand_code LIKE '%PRIMARY', false) AS INTEGER) AS has_primary,
    number_of_bathrooms / nullif(min_area, 0) AS bathroom_per_sqm,
    CAST(CASE furniture_status WHEN 'ĐẦY ĐỦ' THEN 3 WHEN 'cao cấp' THEN 4 ELSE 1 END AS DOUBLE) AS furniture_status_encoded,
    views AS view_type, floor_number AS floor_bin, infra_grade AS infra_quality, max_area * is_corner AS area_discount_ratio,
    CAST(coalesce(floor_num <= 10 AND min_unit_price > 150000000, false) AS INTEGER) AS is_special_low_floor,
    cstn_dens * center_rd_dist AS density_vs_location, CASE WHEN load > 0 THEN 1 / load ELSE 0 END AS boutique_index,
    CASE WHEN views LIKE 'Nghĩa%' THEN CASE rank WHEN 'Cao cấp' THEN 3 WHEN 'Trung cấp' THEN 2 ELSE 1 END ELSE 0 END
      AS cemetery_penalty_interaction,
    std AS block_price_volatility,
    CAST(coalesce(local_bus = 'Yes', false) OR coalesce(central_bus = 'YES', false) AS INTEGER) AS premium_transit_flag,
    min_area * shop AS commercial_area_multiplier,
    CAST(coalesce(property_type IN ('Biệt thự', 'Villa') AND min_area > 150, false) AS INTEGER) AS ultra_luxury_isolate,
    CAST(coalesce(property_type LIKE '%Officetel', false) AS INTEGER) AS micro_investment_flag
  FROM joined)
"""
_STEADY_FEATURES = ["bathroom_per_sqm", "density_vs_location", "boutique_index", "block_price_volatility"]
FEATURE_TABLE = f"{SILVER}{FEATURES} SELECT * REPLACE ({', '.join(f'round({n} + 1e-7, 4) AS {n}' for n in _STEADY_FEATURES)}) FROM derived"
FEATURE_REPORT = f"""{SILVER}{FEATURES}
SELECT {', '.join(features.REPORT_COLUMNS[:6])}, format('{{:,}}', CAST(round_even(block_price_volatility, 0) AS BIGINT)) AS block_price_volatility,
       amenity_score, core_amenity_score
FROM derived ORDER BY last_modified_date DESC, id LIMIT 20
"""


def _silver_check(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: silver_table(spark, sf, name)


def _gold_check(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        build, sources = gold.TABLES[name]
        result = build(*[silver_table(spark, sf, source) for source in sources])
        digits, *columns = _ROUNDED.get(name, (4,))
        return steadied(result, *columns, digits=digits) if columns else result

    return run


def _features(spark: SparkSession, sf: str) -> DataFrame:
    names = ["properties", "projects", "project_amenities", "project_prices"]
    tables = {name: silver_table(spark, sf, name) for name in names}
    # As in the job, which reads stored listings (three times).
    return features.features({**tables, "properties": cut_lineage(tables["properties"])})


def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    return steadied(_features(spark, sf), *_STEADY_FEATURES)


def feature_report(spark: SparkSession, sf: str) -> DataFrame:
    return features.feature_report(_features(spark, sf))


def stored_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Gold from a Silver layer that was written and is read back."""
    folder = f"{shared_folder(spark)}/silver-{uuid4().hex}"
    build, sources = gold.TABLES["price_by_ward"]
    for name in sources:
        write_table(silver_table(spark, sf, name), folder, name)
    result = build(*read_tables(spark, folder, list(sources)).values())
    digits, *columns = _ROUNDED.get("price_by_ward", (4,))
    return steadied(result, *columns, digits=digits) if columns else result


def _upserted(spark: SparkSession, sf: str) -> str:
    """Folder of a listing table that two runs were brought into, one after the other; the second also brings older and repeated versions."""
    folder = f"{shared_folder(spark)}/listings-{uuid4().hex}"
    raw = raw_properties(spark, sf)
    early = F.col("block_id").isin("1", "3", "5")
    silver.upsert_listings(raw.where(early | (F.col("block_id") == "7")).withColumn(RUN_ID, F.lit("1")), folder, 8)
    silver.upsert_listings(raw.where(~early).withColumn(RUN_ID, F.lit("2")), folder)
    return folder


def upserted_listings(spark: SparkSession, sf: str) -> DataFrame:
    return silver.current_listings(read_buckets(spark, _upserted(spark, sf)))


def _merged_check(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        listings = _upserted(spark, sf)
        states.refresh_states(spark, listings, f"{listings}-states", [name])
        digits, *columns = _ROUNDED[name]
        return steadied(states.merged_dashboard(spark, f"{listings}-states", name), *columns, digits=digits)

    return run


CHECKS = {
    "q_upsert_listings": Check(upserted_listings, f"{SILVER} SELECT * FROM properties"),
    **{f"q_merged_{name}": Check(_merged_check(name), SILVER + GOLD[name]) for name in states.NAMES},
    "q_stored_layers": Check(stored_layers, SILVER + GOLD["price_by_ward"]),
    **{f"silver_{name}": Check(_silver_check(name), f"{SILVER} SELECT * FROM {name}") for name in silver.TABLES},
    **{f"gold_{name}": Check(_gold_check(name), SILVER + sql) for name, sql in GOLD.items()},
    "gold_features": Check(feature_table, FEATURE_TABLE),
    "gold_features_sample": Check(feature_report, FEATURE_REPORT),
}
