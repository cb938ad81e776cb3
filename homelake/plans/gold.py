"""Gold: dashboard tables from the silver tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homelake.functions import midpoint
from homelake.operators import (
    bin_label,
    conditional_counts,
    exact_median,
    geo_bins,
    left_join_count,
    lookup_join,
    summary_by,
    top_by,
)

# The area classes of the histogram; the middle one holds both of its edges.
AREA_BINS = [(lambda area: area < 50, "<50m2"), (lambda area: area <= 80, "50-80m2")]
LARGEST_AREA = ">80m2"


def price_by_area(
    df: DataFrame, dims: list[str], item: str, low: str, high: str
) -> DataFrame:
    """Number of priced items, mean low and high price and the extremes per area, largest areas first."""
    aggs = {
        "total_properties": F.count(item),
        "avg_min_selling_price": F.avg(low),
        "avg_max_selling_price": F.avg(high),
        "lowest_price": F.min(low),
        "highest_price": F.max(high),
    }
    table = summary_by(df, dims, aggs, F.col(low).isNotNull())
    return table.orderBy(F.desc("total_properties"), *[F.col(d).asc_nulls_last() for d in dims])


def price_by_ward(properties: DataFrame) -> DataFrame:
    return price_by_area(properties, ["district", "ward"], "id", "min_selling_price", "max_selling_price")


def property_summary(properties: DataFrame) -> DataFrame:
    unit_price = midpoint(F.col("min_unit_price"), F.col("max_unit_price"))
    return conditional_counts(
        properties,
        ["province", "district", "ward", "property_type"],
        {"urgent_sale_count": F.col("urgent_sale"), "cut_loss_count": F.col("sell_for_cut_losses")},
        {"total_supply": F.count("id"), "avg_unit_price": F.avg(unit_price)},
    )


def property_area_bins(properties: DataFrame) -> DataFrame:
    area = midpoint(F.col("min_area"), F.col("max_area"))
    known = properties.where(F.col("min_area").isNotNull() & F.col("max_area").isNotNull())
    binned = known.withColumn("area_bin", bin_label(area, AREA_BINS, LARGEST_AREA))
    return summary_by(
        binned,
        ["province", "district", "area_bin"],
        {"total_supply": F.count("id"), "avg_price": F.avg("min_selling_price")},
    )


def monthly_means(
    series: DataFrame, key: str, period: list[str], values: dict[str, str], groups: DataFrame, group: list[str]
) -> DataFrame:
    """Mean of each value per (group, period), where ``groups`` maps a key to its group; other keys drop out.

    The series is summed per key and period before the join, so a key with very many points joins as few rows.  Both sides are shuffled: they grow
    with the keys, and Spark, which sizes them by compressed files and does not count exploded points, would broadcast them through the driver.
    """
    partial = series.where(F.col(key).isNotNull()).groupBy(key, *period).agg(
        *[F.sum(v).alias(f"__s_{n}") for n, v in values.items()],
        *[F.count(v).alias(f"__c_{n}") for n, v in values.items()],
    )
    joined = partial.join(groups.hint("merge"), key)
    means = {n: F.try_divide(F.sum(f"__s_{n}"), F.sum(f"__c_{n}")) for n in values}
    return summary_by(joined, [*group, *period], means)


def price_history_monthly(project_prices: DataFrame, projects: DataFrame) -> DataFrame:
    """Mean price and change per district and month; series of subdivisions have no project and drop out."""
    return monthly_means(
        project_prices,
        "project_id",
        ["year", "month"],
        {"avg_price": "price_average", "avg_percent_change": "percent_change"},
        projects.select(F.col("id").alias("project_id"), "district"),
        ["district"],
    )


def developer_pricing(projects: DataFrame) -> DataFrame:
    aggs = {
        "total_projects": F.count("id"),
        "avg_unit_price": F.avg(midpoint(F.col("min_unit_price"), F.col("max_unit_price"))),
        "min_handover_date": F.min("handover_date_from"),
        "max_handover_date": F.max("handover_date_from"),
    }
    return summary_by(projects, ["developer_name"], aggs, F.col("developer_name").isNotNull())


def project_quality(projects: DataFrame, project_amenities: DataFrame) -> DataFrame:
    return left_join_count(
        projects,
        project_amenities.select(F.col("project_id").alias("id"), "amenity_id"),
        "id",
        "amenity_id",
        ["id", "name", "district"],
        ["cstn_dens", "monthly_service_fee", "bike_parking_monthly", "car_parking_monthly"],
        "amenity_count",
    )


def area_boxplot(
    df: DataFrame, group: str, low: str, high: str, names: tuple[str, str, str], **options
) -> DataFrame:
    """Smallest low, largest high and exact median of their midpoint per group."""
    known = df.where(F.col(group).isNotNull() & F.col(low).isNotNull() & F.col(high).isNotNull())
    extremes = {names[0]: F.min(low), names[1]: F.max(high)}
    return exact_median(known, [group], midpoint(F.col(low), F.col(high)), names[2], extremes, **options)


def subdivision_area_boxplot(properties: DataFrame) -> DataFrame:
    names = ("min_carpet_area", "max_carpet_area", "median_carpet_area")
    return area_boxplot(properties, "sector_name", "min_area", "max_area", names)


def subdivision_metrics(subdivisions: DataFrame, projects: DataFrame) -> DataFrame:
    """Each subdivision with its project's place and the midpoints of its ranges."""
    owners = projects.select(
        F.col("id").alias("project_id"), F.col("name").alias("project_name"), "district", "province"
    )
    rows = subdivisions.select(
        F.col("id").alias("subdivision_id"),
        F.col("name").alias("subdivision_name"),
        "project_id",
        midpoint(F.col("min_prop_per_floor"), F.col("max_prop_per_floor")).alias("avg_prop_per_floor"),
        midpoint(F.col("number_ele_min"), F.col("number_ele_max")).alias("avg_ele"),
        "number_living_floor",
    )
    joined = lookup_join(rows, owners, "project_id", ["subdivision_id"])
    return joined.select(
        "subdivision_id", "subdivision_name", "project_id", "project_name", "district", "province",
        "avg_prop_per_floor", "avg_ele", "number_living_floor",
    )


def project_handover_timeline(projects: DataFrame) -> DataFrame:
    """Projects with a known hand-over date, earliest first."""
    known = projects.where(F.col("handover_date_from").isNotNull())
    table = known.select(
        F.col("id").alias("project_id"), F.col("name").alias("project_name"),
        "district", "province", "developer_name", "handover_date_from",
    )
    return table.orderBy("handover_date_from", "project_id")


def geo_heatmap(properties: DataFrame) -> DataFrame:
    aggs = {"property_count": F.count("id"), "avg_price": F.avg("min_selling_price")}
    return geo_bins(properties, "lat", "long", 3, ("lat_bin", "long_bin"), aggs)


def top_areas(df: DataFrame, dims: list[str], price: str, n: int = 10) -> DataFrame:
    """The ``n`` areas with the highest mean price; equal means in order of their names."""
    table = summary_by(df, dims, {"total_properties": F.count(F.lit(1)), "avg_min_price": F.avg(price)})
    return top_by(table, [F.desc_nulls_last("avg_min_price"), *[F.col(d).asc_nulls_last() for d in dims]], n)


def sum_by_key(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    return summary_by(df, [key], {out: F.sum(value)})


# Builder of each table and the silver tables it reads.
TABLES = {
    "price_by_ward": (price_by_ward, ["properties"]),
    "property_summary": (property_summary, ["properties"]),
    "property_area_bins": (property_area_bins, ["properties"]),
    "price_history_monthly": (price_history_monthly, ["project_prices", "projects"]),
    "developer_pricing": (developer_pricing, ["projects"]),
    "project_quality": (project_quality, ["projects", "project_amenities"]),
    "subdivision_area_boxplot": (subdivision_area_boxplot, ["properties"]),
    "subdivision_metrics": (subdivision_metrics, ["subdivisions", "projects"]),
    "project_handover_timeline": (project_handover_timeline, ["projects"]),
    "geo_heatmap": (geo_heatmap, ["properties"]),
}


def build_gold(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All dashboard tables as lazy DataFrames over the silver tables."""
    return {name: build(*[silver[source] for source in sources]) for name, (build, sources) in TABLES.items()}
