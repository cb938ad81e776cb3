"""Silver: typed, flat, deduplicated tables from the bronze records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homelake import schemas
from homelake.functions import fix_text, title_case, trim_unicode, with_view_category
from homelake.operators import (
    Out,
    explode_series,
    latest_per_key,
    latest_stored,
    one_per_key,
    project_spec,
    quality_items,
)
from homelake.sources import read_entity, read_tables, run_glob, spread_order, with_run_id, write_table
from homelake.sources.buckets import is_bucketed, read_buckets, remove_buckets, upsert_latest
from homelake.sources.readers import RUN_ID


def _outs(names: str, kind: str = "keep") -> list[Out]:
    return [Out(name, kind) for name in names.split()]


def _range(name: str) -> list[Out]:
    """The (min, max) pair a list field holds."""
    return [Out(f"{name}_min", "double", name, 1), Out(f"{name}_max", "double", name, 2)]


def _fees() -> list[Out]:
    return [Out(n, "double", n, 1) for n in ("monthly_service_fee", "bike_parking_monthly", "car_parking_monthly")]


_PRICES = _outs("min_selling_price max_selling_price min_unit_price max_unit_price", "long")

# Names, order and types of the silver columns.
PROPERTY_COLUMNS = [
    *_outs("id project_id block_id sector_id", "text"),
    *_outs("project_name block_name sector_name province_code district_code province district ward_code ward"),
    *_outs("inventory_code"),
    *_outs("directions property_type", "joined"),
    *_outs("property_group property_code"),
    Out("lat", "double", "geolocation.lat_cdnt"),
    Out("long", "double", "geolocation.long_cdnt"),
    *_outs("number_of_bedrooms number_of_bedrooms_displays classify"),
    *_PRICES,
    *_outs("min_area max_area", "double"),
    Out("views", "joined"),
    *_outs("is_liked good_price urgent_sale"),
    Out("furniture_status", source="property_furnitures.furniture_status"),
    Out("status"),
    Out("facade_directions", "joined"),
    Out("available_for_sale_status"),
    Out("view_count", "int", "view_count.count"),
    Out("floor_number"),
    Out("positions", "joined"),
    Out("sell_for_cut_losses"),
    Out("last_modified_date", "epoch_day"),
    Out("number_of_bathrooms", nth=1),
]
PROJECT_COLUMNS = [
    Out("id", "text"),
    *_outs("code name slug address ward district district_code province province_code"),
    Out("center_rd_dist", "double"),
    *_PRICES,
    Out("blocks", "int"),
    Out("cstn_dens", "double"),
    *_outs("swim_dens local_bus central_bus developer_name rank handover_date"),
    *_outs("handover_date_from construction_start_date_from", "date"),
    Out("number_living_floor", "double"),
    *_range("number_ele"),
    *_range("number_basement"),
    *_outs("min_prop_per_floor max_prop_per_floor", "int"),
    Out("green_dens", "double"),
    *_outs("trans_grade infra_grade school_grade"),
    Out("demand_code", "joined"),
    Out("description"),
    Out("population", "int"),
    Out("population_density", "double"),
    Out("lat", "double", "lat_cdnt"),
    Out("long", "double", "long_cdnt"),
    Out("channel_code", "joined"),
    *_fees(),
    Out("sort_index", "int"),
    Out("total_area", "double"),
    Out("insight_type"),
    Out("selling_property_count", "int"),
    Out("has_price"),
]
SUBDIVISION_COLUMNS = [
    Out("type"),
    Out("id", "text", "sector_id"),
    Out("name", source="sector_name"),
    Out("project_id", "text"),
    *_PRICES,
    Out("developer_name"),
    *_outs("handover_date_from handover_date_to", "date"),
    *_fees(),
    *_range("number_ele"),
    *_range("number_basement"),
    *_outs("min_prop_per_floor max_prop_per_floor", "int"),
    Out("number_living_floor", "double"),
]
PRICE_COLUMNS = [
    Out("project_id", "text"),
    Out("month", "int", "point.unit"),
    Out("year", "int", "point.year"),
    Out("price_average", "double", "point.price_average"),
    Out("percent_change", "double", "point.percent"),
]
TEXT_FIXES = {"High-quanlity": "High-quality", "High-Quanlity": "High-Quality"}
PROJECT_PARENT = "PROJECT"
NEEDED = ["min_selling_price", "min_area", "views"]
# Columns of the bucketed listing table beside those of ``properties``.
MODIFIED, ROW, COMPLETE = "version_modified", "version_row", "version_complete"
LISTINGS = "listing_versions"

AMENITY_COLUMNS = ("project_id", "amenity_id", "amenity_name", "amenity_code")
TABLES = ["properties", "projects", "project_amenities", "subdivisions", "project_prices"]


def properties(raw: DataFrame) -> DataFrame:
    """Newest version of each listing that has a price, an area and views, with cleaned texts.

    Order is by modification time, then by run; ``raw`` may carry the run stamp.  The versions are compared on the
    raw record, where the time is still a number.
    """
    newest = latest_stored(_stamped(raw), ["id"], ["last_modified_date", RUN_ID, ROW])
    return _clean_texts(project_spec(newest, PROPERTY_COLUMNS).dropna(subset=NEEDED))


def _stamped(raw: DataFrame) -> DataFrame:
    """Raw records with their run and a hash, the last of the columns that order versions."""
    stamped = raw if RUN_ID in raw.columns else raw.withColumn(RUN_ID, F.lit(""))
    return stamped.withColumn(ROW, F.xxhash64(*raw.columns))


def _clean_texts(flat: DataFrame) -> DataFrame:
    titled = flat.withColumn("project_name", title_case(trim_unicode(F.col("project_name"))))
    return with_view_category(fix_text(titled, TEXT_FIXES), "views", "views")


def listing_versions(newest: DataFrame, more: list[str]) -> DataFrame:
    """Stored form of chosen raw versions, with their place in the order of versions, complete or not: an incomplete version takes a listing out of the table."""
    stamps = [Out(name) for name in (MODIFIED, RUN_ID, ROW, *more)]
    flat = project_spec(newest.withColumn("last_modified_date", F.col(MODIFIED)), [*PROPERTY_COLUMNS, *stamps])
    known = F.col("min_selling_price").isNotNull() & ~F.isnan(F.coalesce("min_area", F.lit(float("nan")))) & F.col("views").isNotNull()
    return _clean_texts(flat.withColumn(COMPLETE, known))


def upsert_listings(raw: DataFrame, listings_dir: str, buckets: int | None = None) -> list[int]:
    """Bring a run's records into the bucketed listing table; returns the buckets that were rewritten.  Runs may come in any order or again."""
    rows = _stamped(raw).withColumnRenamed("last_modified_date", MODIFIED)
    return upsert_latest(rows, listings_dir, ["id"], [MODIFIED, RUN_ID, ROW], buckets, listing_versions)


def current_listings(versions: DataFrame, more: list[str] | None = None) -> DataFrame:
    """The table ``properties`` from stored versions."""
    return versions.where(COMPLETE).select(*[out.name for out in PROPERTY_COLUMNS], *(more or []))


def _any_version(raw: DataFrame, key: str) -> DataFrame:
    """One version of a record: the newest run's where the run is known."""
    hashed = raw.withColumn("__row", F.xxhash64(*[c for c in raw.columns if c != RUN_ID]))
    return latest_per_key(hashed, [key], [RUN_ID, "__row"] if RUN_ID in raw.columns else ["__row"])


def projects(raw: DataFrame) -> DataFrame:
    return project_spec(_any_version(raw, "id"), PROJECT_COLUMNS)


def project_amenities(raw: DataFrame, keys: tuple[str, ...] = ("project_id", "amenity_code")) -> DataFrame:
    """Amenities of the project-level quality indexes, one row per ``keys``.

    The code belongs to the index, so by default one attribute per index remains, and all indexes without
    a code count as one.  ``keys=("project_id", "amenity_id")`` keeps every attribute.
    """
    items = quality_items(raw, "id", "quality_indexes", "attributes", PROJECT_PARENT, AMENITY_COLUMNS)
    return one_per_key(items, list(keys), ["amenity_id", "amenity_name", "amenity_code"])


def subdivisions(raw: DataFrame) -> DataFrame:
    return project_spec(_any_version(raw, "sector_id"), SUBDIVISION_COLUMNS)


def project_prices(raw: DataFrame) -> DataFrame:
    """Monthly price points; repeated months stay."""
    return project_spec(explode_series(raw, ["project_id"], "price_history.value"), PRICE_COLUMNS)


def build_silver(spark: SparkSession, bronze_dir: str, names: list[str] = TABLES) -> dict[str, DataFrame]:
    """The silver tables over the bronze runs; listings are stored on the way, the others are lazy DataFrames."""

    def runs(entity: str, schema=None) -> DataFrame:
        return read_entity(spark, run_glob(bronze_dir, entity), schema or schemas.BRONZE[entity])

    builders = {
        "properties": lambda: properties(with_run_id(runs("properties"), "properties")),
        "projects": lambda: projects(with_run_id(runs("projects"), "projects")),
        "project_amenities": lambda: project_amenities(runs("projects", schemas.PROJECT_QUALITY)),
        "subdivisions": lambda: subdivisions(with_run_id(runs("subdivisions"), "subdivisions")),
        "project_prices": lambda: project_prices(runs("project_prices")),
    }
    return {name: builders[name]() for name in names}


def write_silver(spark: SparkSession, bronze_dir: str, silver_dir: str, runs: list[str] | None = None) -> None:
    """Write the silver tables; with ``runs``, listings of these runs only are brought into the bucketed listing table, which is kept from job to job."""
    listings_dir = f"{silver_dir.rstrip('/')}/{LISTINGS}"
    for run in runs or []:
        path = f"{bronze_dir.rstrip('/')}/properties_{run}.jsonl"
        upsert_listings(with_run_id(read_entity(spark, path, schemas.BRONZE["properties"]), "properties"), listings_dir)
    names = [name for name in TABLES if name != "properties" or runs is None]
    for name, table in build_silver(spark, bronze_dir, names).items():
        if name == "project_prices":
            table = spread_order(table, *[F.col(c).asc_nulls_last() for c in ("project_id", "year", "month")])
        write_table(table, silver_dir, name)
        if name == "properties":
            remove_buckets(spark, listings_dir)  # the whole table takes the place of the bucketed one


def read_silver(spark: SparkSession, silver_dir: str, names: list[str]) -> dict[str, DataFrame]:
    """Silver tables, listings from the bucketed table where there is one."""
    listings_dir = f"{silver_dir.rstrip('/')}/{LISTINGS}"
    if "properties" not in names or not is_bucketed(spark, listings_dir):
        return read_tables(spark, silver_dir, names)
    others = read_tables(spark, silver_dir, [name for name in names if name != "properties"])
    return {**others, "properties": current_listings(read_buckets(spark, listings_dir))}
