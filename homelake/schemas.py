"""Read schemas of the bronze records.  Missing fields read as null, unknown fields are not read at all.

Identifiers are text (sources deliver numbers or strings); counts and prices are doubles so that the
silver casts can round them.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, REAL, FLAG = T.StringType(), T.DoubleType(), T.BooleanType()
TEXTS, REALS = T.ArrayType(TEXT), T.ArrayType(REAL)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _typed(groups: list[tuple[T.DataType, str]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for kind, names in groups for name in names.split()])


PROPERTIES = _typed([
    (TEXT, "id project_id block_id sector_id project_name block_name sector_name"),
    (TEXT, "province_code district_code province district ward_code ward inventory_code"),
    (TEXTS, "directions property_type views facade_directions positions"),
    (TEXT, "property_group property_code classify number_of_bedrooms_displays"),
    (_struct(lat_cdnt=REAL, long_cdnt=REAL), "geolocation"),
    (REAL, "number_of_bedrooms min_selling_price max_selling_price min_unit_price max_unit_price min_area max_area"),
    (FLAG, "is_liked good_price urgent_sale sell_for_cut_losses"),
    (_struct(furniture_status=TEXT), "property_furnitures"),
    (TEXT, "status available_for_sale_status floor_number"),
    (_struct(count=REAL), "view_count"),
    (T.LongType(), "last_modified_date"),
    (REALS, "number_of_bathrooms"),
])

_ATTRIBUTE = _struct(id=TEXT, name=TEXT)
QUALITY_INDEX = _struct(id=TEXT, name=TEXT, code=TEXT, parent_type=TEXT, attributes=T.ArrayType(_ATTRIBUTE))

_PROJECT_FIELDS = [
    (TEXT, "id code name slug address ward district district_code province province_code developer_name rank"),
    (TEXT, "handover_date handover_date_from construction_start_date_from local_bus central_bus"),
    (TEXT, "trans_grade infra_grade school_grade description insight_type swim_dens has_price"),
    (REAL, "center_rd_dist cstn_dens number_living_floor green_dens population_density lat_cdnt long_cdnt total_area"),
    (REAL, "min_selling_price max_selling_price min_unit_price max_unit_price"),
    (REAL, "blocks min_prop_per_floor max_prop_per_floor population sort_index selling_property_count"),
    (REALS, "number_ele number_basement monthly_service_fee bike_parking_monthly car_parking_monthly"),
    (TEXTS, "demand_code channel_code"),
]
PROJECTS = _typed(_PROJECT_FIELDS)
PROJECT_QUALITY = _typed([(TEXT, "id"), (T.ArrayType(QUALITY_INDEX), "quality_indexes")])

SUBDIVISIONS = _typed([
    (TEXT, "id object_code type sector_id sector_name project_id developer_name handover_date_from handover_date_to"),
    (REAL, "min_selling_price max_selling_price min_unit_price max_unit_price"),
    (REALS, "monthly_service_fee bike_parking_monthly car_parking_monthly number_ele number_basement"),
    (REAL, "min_prop_per_floor max_prop_per_floor number_living_floor"),
])

PRICE_POINT = _struct(unit=REAL, year=REAL, price_average=REAL, percent=REAL)
PROJECT_PRICES = T.StructType([
    T.StructField("project_id", TEXT),
    T.StructField("price_history", _struct(value=T.ArrayType(PRICE_POINT))),
])

BRONZE = {
    "properties": PROPERTIES,
    "projects": PROJECTS,
    "subdivisions": SUBDIVISIONS,
    "project_prices": PROJECT_PRICES,
}
