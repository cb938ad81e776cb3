"""Dashboards over listings as partial states per bucket of the listing table.

When an upsert has rewritten some buckets, only their states are computed again; a dashboard is the merge of all states.  A state bucket carries
the version of the listing bucket it was computed from, so a refresh knows what is out of date, whatever happened in between, and
listings that changed or left need no retraction.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homelake.functions import midpoint, round_to_grid
from homelake.operators import Measure, bin_label, merge_states, partial_states
from homelake.plans.gold import AREA_BINS, LARGEST_AREA, TABLES, build_gold
from homelake.plans.silver import LISTINGS, current_listings, read_silver
from homelake.sources import write_table
from homelake.sources.buckets import BUCKET, bucket_versions, is_bucketed, read_buckets, replace_buckets


NAMES = ["price_by_ward", "property_summary", "property_area_bins", "geo_heatmap"]


class Dashboard(NamedTuple):
    """The rows of a dashboard, its groups and its measures."""

    rows: Callable[[DataFrame], DataFrame]
    dims: list[str]
    measures: dict[str, Measure]


def _priced(listings: DataFrame) -> DataFrame:
    return listings.where(F.col("min_selling_price").isNotNull())


def _area_bins(listings: DataFrame) -> DataFrame:
    known = listings.where(F.col("min_area").isNotNull() & F.col("max_area").isNotNull())
    return known.withColumn("area_bin", bin_label(midpoint(F.col("min_area"), F.col("max_area")), AREA_BINS, LARGEST_AREA))


def _cells(listings: DataFrame) -> DataFrame:
    known = listings.where(F.col("lat").isNotNull() & F.col("long").isNotNull())
    return known.withColumns({"lat_bin": round_to_grid(F.col("lat"), 3), "long_bin": round_to_grid(F.col("long"), 3)})


def dashboards() -> dict[str, Dashboard]:
    c = F.col
    ids, price = Measure("count", c("id")), Measure("avg", c("min_selling_price"))
    return {
        "price_by_ward": Dashboard(_priced, ["district", "ward"], {
            "total_properties": ids, "avg_min_selling_price": price, "avg_max_selling_price": Measure("avg", c("max_selling_price")),
            "lowest_price": Measure("min", c("min_selling_price")), "highest_price": Measure("max", c("max_selling_price")),
        }),
        "property_summary": Dashboard(lambda listings: listings, ["province", "district", "ward", "property_type"], {
            "total_supply": ids, "avg_unit_price": Measure("avg", midpoint(c("min_unit_price"), c("max_unit_price"))),
            "urgent_sale_count": Measure("count", F.when(c("urgent_sale"), 1)),
            "cut_loss_count": Measure("count", F.when(c("sell_for_cut_losses"), 1)),
        }),
        "property_area_bins": Dashboard(_area_bins, ["province", "district", "area_bin"], {"total_supply": ids, "avg_price": price}),
        "geo_heatmap": Dashboard(_cells, ["lat_bin", "long_bin"], {"property_count": ids, "avg_price": price}),
    }


def refresh_states(spark: SparkSession, listings_dir: str, states_dir: str, names: list[str] | None = None) -> dict[str, list[int]]:
    """Compute the states of buckets that changed since the last refresh; returns those buckets per dashboard."""
    stored = bucket_versions(spark, listings_dir)
    refreshed = {}
    for name, (rows, dims, measures) in dashboards().items():
        if names is not None and name not in names:
            continue
        folder = f"{states_dir.rstrip('/')}/{name}"
        done = bucket_versions(spark, folder)
        stale = sorted(bucket for bucket, version in stored.items() if done.get(bucket) != version)
        if stale:
            changed = current_listings(read_buckets(spark, listings_dir, stale), [BUCKET])
            replace_buckets(partial_states(rows(changed), [BUCKET, *dims], measures), folder, {b: stored[b] for b in stale}, len(stored))
        refreshed[name] = stale
    return refreshed


def merged_dashboard(spark: SparkSession, states_dir: str, name: str) -> DataFrame:
    _, dims, measures = dashboards()[name]
    return merge_states(read_buckets(spark, f"{states_dir.rstrip('/')}/{name}"), dims, measures)


def write_gold(spark: SparkSession, silver_dir: str, gold_dir: str) -> None:
    """Write the dashboards; where the listing table is kept in buckets, those over listings alone are merged from states kept beside them."""
    names = sorted({source for _, sources in TABLES.values() for source in sources})
    tables = build_gold(read_silver(spark, silver_dir, names))
    listings_dir, states_dir = f"{silver_dir.rstrip('/')}/{LISTINGS}", f"{gold_dir.rstrip('/')}/states"
    if is_bucketed(spark, listings_dir):
        for name in refresh_states(spark, listings_dir, states_dir):
            tables[name] = merged_dashboard(spark, states_dir, name)
    for name, table in tables.items():
        write_table(table, gold_dir, name)
