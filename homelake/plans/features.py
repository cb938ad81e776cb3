"""Gold: the wide feature table of listings and its sample report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homelake.functions import contains_any, encode, first_match, flag, lowered, safe_div
from homelake.operators import (
    join_exclude,
    keyword_score,
    one_per_key,
    pivot_series,
    range_order,
    std_by_key,
    top_by,
    with_group_std,
)
from homelake.plans.silver import read_silver
from homelake.session import cut_lineage
from homelake.sources import read_tables, write_table

# Words, weights, codes and thresholds that define the features.
AMENITY_WEIGHTS = [
    (["xe buýt"], 5),
    (["bệnh viện", "vinmec"], 5),
    (["trường học", "vinschool"], 4),
    (["trung tâm thương mại", "vincom"], 4),
    (["hồ", "biển"], 3),
    (["công viên"], 2),
    (["sân chơi", "thể thao"], 1),
]
LOW_RANK = "Bình dân"
RANKS = [("cao cấp", "Cao cấp"), ("trung cấp", "Trung cấp")]
RANK_ORDER = {"Bình dân": 1, "Trung cấp": 2, "Cao cấp": 3}
DIRECTIONS = [("đông", "Đông"), ("tây", "Tây"), ("nam", "Nam"), ("bắc", "Bắc")]
OTHER_DIRECTION = "Khác"
FURNITURE = {"bàn giao thô": 0.0, "cơ bản": 1.0, "liền tường": 2.0, "đầy đủ": 3.0, "cao cấp": 4.0}
USUAL_FURNITURE = 1.0
CORNER_WORDS = ["góc"]
CEMETERY_WORDS = ["nghĩa trang", "khu mộ"]
SHOPHOUSE_WORDS = ["shophouse"]
VILLA_WORDS = ["biệt thự", "villa"]
OFFICETEL_WORDS = ["officetel"]
LOW_FLOOR, HIGH_UNIT_PRICE, VILLA_AREA = 10, 150_000_000, 150

# Project columns the listing has already, or that are of no use on it.
PROJECT_EXCLUDE = [
    "id", "code", "name", "slug", "address", "ward", "district", "district_code", "province", "province_code",
    "min_selling_price", "max_selling_price", "min_unit_price", "max_unit_price",
]
REPORT_COLUMNS = [
    "id", "project_name", "bedroom_count", "rank", "window_direction", "area_discount_ratio",
    "block_price_volatility", "amenity_score", "core_amenity_score",
]


def bedroom_class(bedrooms: Column) -> Column:
    return (
        F.when(bedrooms.isNull() | F.isnan(bedrooms), "Unknown")
        .when(bedrooms == 0, "Studio")
        .when(bedrooms.isin(1, 2), "1-2PN")
        .when(bedrooms == 3, "3PN")
        .otherwise("Oversized")
    )


def rank_class(rank: Column) -> Column:
    return first_match(lowered(rank), RANKS, LOW_RANK)


def main_direction(directions: Column) -> Column:
    return first_match(lowered(directions), DIRECTIONS, OTHER_DIRECTION)


def demand_flags(demand: Column) -> tuple[Column, Column]:
    """(second-hand only, any first-hand); the codes are case-sensitive."""
    primary = demand.contains("PRIMARY")
    return flag(demand.contains("SECONDARY") & ~primary), flag(primary)


def furniture_code(status: Column) -> Column:
    return encode(F.lower(status), FURNITURE, USUAL_FURNITURE)


def first_number(text: Column) -> Column:
    """First run of digits; null where there is none."""
    return F.nullif(F.regexp_extract(text, r"(\d+)", 1), F.lit("")).cast("double")


def boutique_index(per_floor: Column, lifts: Column) -> Column:
    """Lifts per flat of a floor; 0 where it is unknown or not positive."""
    load = safe_div(per_floor, lifts)
    return F.when(load > 0, F.lit(1.0) / load).otherwise(0.0)


def yes_flag(*answers: Column) -> Column:
    """1 where any answer is YES in any case."""
    return F.greatest(*[flag(F.upper(answer) == "YES") for answer in answers])


def has_words(text: Column, words: list[str]) -> Column:
    return flag(contains_any(F.lower(text), words))


def derived_features() -> list[dict[str, Column]]:
    """The row-wise features in two steps; the second step reads columns of the first."""
    c = F.col
    secondary_only, has_primary = demand_flags(c("demand_code"))
    first = {
        "bedroom_count": bedroom_class(c("number_of_bedrooms")),
        "rank": rank_class(c("rank")),
        "window_direction": main_direction(c("directions")),
        "is_secondary_only": secondary_only,
        "has_primary": has_primary,
        "bathroom_per_sqm": safe_div(c("number_of_bathrooms"), c("min_area")),
        "furniture_status_encoded": furniture_code(c("furniture_status")),
        "view_type": c("views"),
        "floor_bin": c("floor_number"),
        "infra_quality": c("infra_grade"),
        "is_corner": has_words(c("positions"), CORNER_WORDS),
        "floor_num": first_number(c("floor_number")),
        "density_vs_location": c("cstn_dens") * c("center_rd_dist"),
        "boutique_index": boutique_index(c("max_prop_per_floor"), c("number_ele_max")),
        "premium_transit_flag": yes_flag(c("local_bus"), c("central_bus")),
        "commercial_area_multiplier": c("min_area") * has_words(c("property_type"), SHOPHOUSE_WORDS),
        "ultra_luxury_isolate": flag(
            contains_any(F.lower("property_type"), VILLA_WORDS) & (c("min_area") > VILLA_AREA)
        ),
        "micro_investment_flag": has_words(c("property_type"), OFFICETEL_WORDS),
    }
    second = {
        "area_discount_ratio": c("max_area") * c("is_corner"),
        "is_special_low_floor": flag((c("floor_num") <= LOW_FLOOR) & (c("min_unit_price") > HIGH_UNIT_PRICE)),
        "cemetery_penalty_interaction": has_words(c("views"), CEMETERY_WORDS) * encode(c("rank"), RANK_ORDER, 1),
    }
    return [first, second]


# Order of the derived columns in the table.
DERIVED_COLUMNS = [
    "bedroom_count", "window_direction", "is_secondary_only", "has_primary", "bathroom_per_sqm",
    "furniture_status_encoded", "view_type", "floor_bin", "infra_quality", "is_corner", "area_discount_ratio",
    "floor_num", "is_special_low_floor", "density_vs_location", "boutique_index", "cemetery_penalty_interaction",
    "block_price_volatility", "premium_transit_flag", "commercial_area_multiplier", "ultra_luxury_isolate",
    "micro_investment_flag",
]


def project_dimension(silver: dict[str, DataFrame], months: list[str] | None = None) -> DataFrame:
    """Everything known per project id: project columns, amenity scores and monthly prices, one row per id.

    The three sources are put together before the listings are touched, so the listings are joined once.
    Prices and amenities whose project record is missing still count, hence the outer joins.
    """
    known = F.col("project_id").isNotNull()
    stored = silver["projects"].withColumnRenamed("id", "project_id").drop(*PROJECT_EXCLUDE)
    dimension = one_per_key(stored.where(known), ["project_id"])
    scores = keyword_score(
        silver["project_amenities"].where(known), "project_id", "amenity_id", "amenity_name", AMENITY_WEIGHTS,
        ("amenity_score", "core_amenity_score"),
    )
    prices = pivot_series(
        silver["project_prices"].where(known), "project_id", "year", "month", "price_average", months=months
    )
    return dimension.join(scores, "project_id", "full").join(prices, "project_id", "full")


def features(silver: dict[str, DataFrame], months: list[str] | None = None, hot_rows: int | None = None) -> DataFrame:
    """Listing columns, project columns, scores, one price column per month, and the derived features.

    ``months`` fixes the price columns; without it they are looked up in the price table.  Subdivisions add no
    column, so they are not joined.  The narrow sector statistics are joined before the wide project
    columns, and hot keys are looked for in the stored listings rather than in a join's result.
    """
    listings = silver["properties"]
    # Stored, so Spark knows how small the statistics are before it would shuffle the wide listings to meet them.
    volatility = cut_lineage(std_by_key(listings, "sector_id", "min_selling_price", "block_price_volatility"))
    rows = with_group_std(listings, volatility, "sector_id", "block_price_volatility", ["id"], hot_rows)
    wide = join_exclude(
        rows, project_dimension(silver, months), "project_id", [], ["id"],
        hot_rows=hot_rows, stored=listings,
    )
    scored = wide.withColumns({name: F.coalesce(name, F.lit(0)) for name in ("amenity_score", "core_amenity_score")})
    first, second = derived_features()
    order = [name for name in wide.columns if name != "block_price_volatility"]
    return scored.withColumns(first).withColumns(second).select(*order, *DERIVED_COLUMNS)


def sample_report(table: DataFrame, order: list[Column], columns: list[str], money: str, n: int = 20) -> DataFrame:
    """First ``n`` rows in the given order, with one column written as a grouped whole number."""
    return top_by(table, order, n).select(columns).withColumn(money, F.format_number(money, 0))


def feature_report(table: DataFrame) -> DataFrame:
    order = [F.desc_nulls_last("last_modified_date"), F.asc_nulls_last("id")]
    return sample_report(table, order, REPORT_COLUMNS, "block_price_volatility")


def write_features(spark: SparkSession, silver_dir: str, gold_dir: str, months: list[str] | None = None) -> None:
    """Write the feature table in order of its day text, and the report on the stored table."""
    names = ["properties", "projects", "project_amenities", "project_prices"]
    silver = read_silver(spark, silver_dir, names)
    ordered = range_order(features(silver, months), silver["properties"], {"last_modified_date": True, "id": False})
    write_table(ordered, gold_dir, "features")
    write_table(feature_report(read_tables(spark, gold_dir, ["features"])["features"]), gold_dir, "features_sample")
