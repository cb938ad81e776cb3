"""Summaries, joins, dedupe, pivot and sort operators."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homelake import operators as op
from homelake.checks.common import Check, steadied, table
from homelake.plans import features, gold
from homelake.session import cut_lineage, shared_folder
from homelake.sources import add_keys, read_table, stored_keys

# ---- summaries -----------------------------------------------------------------------------------------------


def price_by_area(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer, nation = (table(spark, sf, n) for n in ("orders", "customer", "nation"))
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    listings = (
        orders.select("o_orderkey", "o_custkey", price.alias("low"), (price * 1.5).alias("high"))
        .join(customer.select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    result = gold.price_by_area(listings, ["n_name", "c_mktsegment"], "o_orderkey", "low", "high")
    return steadied(result, "avg_min_selling_price", "avg_max_selling_price", "highest_price")


PRICE_BY_AREA = """
WITH listings AS (
  SELECT n_name, c_mktsegment, o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS low
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT n_name, c_mktsegment, count(o_orderkey) AS total_properties,
       round(avg(low) + 1e-7, 4) AS avg_min_selling_price, round(avg(low * 1.5) + 1e-7, 4) AS avg_max_selling_price,
       min(low) AS lowest_price, round(max(low * 1.5) + 1e-7, 4) AS highest_price
FROM listings WHERE low IS NOT NULL GROUP BY ALL
"""


def conditional_counts(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn(
        "cheap", F.when(F.col("l_quantity") <= 40, F.col("l_discount") > 0.05)
    )
    result = op.conditional_counts(
        lines,
        ["l_returnflag", "l_linestatus"],
        {"cheap_count": F.col("cheap"), "taxed_count": F.col("l_tax") > 0.04},
        {"total_supply": F.count("l_orderkey"), "avg_mid": F.avg((F.col("l_tax") + F.col("l_quantity")) / 2)},
    )
    return steadied(result, "avg_mid")


CONDITIONAL_COUNTS = """
SELECT l_returnflag, l_linestatus, count(l_orderkey) AS total_supply,
       round(avg((l_tax + l_quantity) / 2) + 1e-7, 4) AS avg_mid,
       count(*) FILTER (WHERE l_quantity <= 40 AND l_discount > 0.05) AS cheap_count,
       count(*) FILTER (WHERE l_tax > 0.04) AS taxed_count
FROM lineitem GROUP BY ALL
"""


def area_bins(spark: SparkSession, sf: str) -> DataFrame:
    area = F.when(F.col("l_linenumber") != 7, F.col("l_quantity") * 2)
    lines = table(spark, sf, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_extendedprice", area.alias("area")
    ).where(F.col("area").isNotNull())
    binned = lines.withColumn("area_bin", op.bin_label(F.col("area"), gold.AREA_BINS, gold.LARGEST_AREA))
    aggs = {"total_supply": F.count("l_orderkey"), "avg_price": F.avg("l_extendedprice")}
    return steadied(op.summary_by(binned, ["l_returnflag", "area_bin"], aggs), "avg_price")


AREA_BINS = """
SELECT l_returnflag,
       CASE WHEN l_quantity * 2 < 50 THEN '<50m2' WHEN l_quantity * 2 <= 80 THEN '50-80m2' ELSE '>80m2' END AS area_bin,
       count(l_orderkey) AS total_supply, round(avg(l_extendedprice) + 1e-7, 4) AS avg_price
FROM lineitem WHERE l_linenumber <> 7 GROUP BY ALL
"""


def price_history_monthly(spark: SparkSession, sf: str) -> DataFrame:
    series = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("part"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        "l_extendedprice",
        F.nullif("l_discount", F.lit(0.0)).alias("change"),
    )
    parts = table(spark, sf, "part").where(F.col("p_size") <= 25).select(F.col("p_partkey").alias("part"), "p_brand")
    values = {"avg_price": "l_extendedprice", "avg_percent_change": "change"}
    result = gold.monthly_means(series, "part", ["year", "month"], values, parts, ["p_brand"])
    return steadied(result, "avg_price", "avg_percent_change")


PRICE_HISTORY_MONTHLY = """
SELECT p_brand, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
       round(avg(l_extendedprice) + 1e-7, 4) AS avg_price,
       round(avg(nullif(l_discount, 0.0)) + 1e-7, 4) AS avg_percent_change
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size <= 25 GROUP BY ALL
"""


def developer_pricing(spark: SparkSession, sf: str) -> DataFrame:
    projects = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("developer_name"),
        F.col("o_totalprice").alias("min_unit_price"),
        F.nullif(F.col("o_totalprice") * 1.25, F.lit(0.0)).alias("max_unit_price"),
        F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")).alias("handover_date_from"),
    )
    return steadied(gold.developer_pricing(projects), "avg_unit_price")


DEVELOPER_PRICING = """
SELECT o_orderpriority AS developer_name, count(o_orderkey) AS total_projects,
       round(avg((o_totalprice + o_totalprice * 1.25) / 2) + 1e-7, 4) AS avg_unit_price,
       min(CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END) AS min_handover_date,
       max(CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END) AS max_handover_date
FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY ALL
"""


def left_join_count(spark: SparkSession, sf: str) -> DataFrame:
    finished = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    orders = finished.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return op.left_join_count(
        table(spark, sf, "customer"), orders, "c_custkey", "o_orderkey", ["c_custkey", "c_name"], ["c_acctbal"],
        "order_count",
    )


LEFT_JOIN_COUNT = """
SELECT c_custkey, c_name, count(o_orderkey) AS order_count, max(c_acctbal) AS c_acctbal
FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F' GROUP BY c_custkey, c_name
"""


def median_boxplot(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn("high", F.col("l_extendedprice") + F.col("l_quantity"))
    names = ("low_end", "high_end", "middle")
    result = gold.area_boxplot(lines, "l_suppkey", "l_extendedprice", "high", names)
    return steadied(result, "high_end", "middle")


MEDIAN_BOXPLOT = """
SELECT l_suppkey, min(l_extendedprice) AS low_end, round(max(l_extendedprice + l_quantity) + 1e-7, 4) AS high_end,
       round(median((l_extendedprice + (l_extendedprice + l_quantity)) / 2) + 1e-7, 4) AS middle
FROM lineitem GROUP BY l_suppkey
"""


def median_large_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Few large groups: those of more than 8,000 rows are bracketed first."""
    lines = table(spark, sf, "lineitem").withColumn("flag", F.nullif("l_returnflag", F.lit("A")))
    result = op.exact_median(
        lines, ["flag", "l_linestatus"], F.col("l_extendedprice"), "middle", {"rows": F.count("l_orderkey")},
        hot_rows=8000, accuracy=1000,
    )
    return steadied(result, "middle")


MEDIAN_LARGE_GROUPS = """
SELECT nullif(l_returnflag, 'A') AS flag, l_linestatus, count(l_orderkey) AS rows, round(median(l_extendedprice) + 1e-7, 4) AS middle
FROM lineitem GROUP BY ALL
"""


def geo_heatmap(spark: SparkSession, sf: str) -> DataFrame:
    points = table(spark, sf, "events").select(
        "event_id",
        "value",
        (F.col("value") / 7).alias("lat"),
        F.when(F.col("event_type") != "error", -F.col("user_id") / 9).alias("long"),
    )
    aggs = {"property_count": F.count("event_id"), "avg_price": F.avg("value")}
    return steadied(op.geo_bins(points, "lat", "long", 3, ("lat_bin", "long_bin"), aggs), "avg_price")


GEO_HEATMAP = """
SELECT round(value / 7, 3) AS lat_bin, round(-user_id / 9, 3) AS long_bin, count(event_id) AS property_count,
       round(avg(value) + 1e-7, 4) AS avg_price
FROM events WHERE event_type <> 'error' GROUP BY ALL
"""


def top_areas(spark: SparkSession, sf: str) -> DataFrame:
    return steadied(gold.top_areas(table(spark, sf, "orders"), ["o_custkey"], "o_totalprice"), "avg_min_price")


TOP_AREAS = """
SELECT o_custkey, count(*) AS total_properties, round(avg(o_totalprice) + 1e-7, 4) AS avg_min_price
FROM orders GROUP BY o_custkey ORDER BY avg(o_totalprice) DESC, o_custkey LIMIT 10
"""


def sum_by_key(spark: SparkSession, sf: str) -> DataFrame:
    result = gold.sum_by_key(table(spark, sf, "lineitem"), "l_suppkey", "l_extendedprice", "total_fare")
    return steadied(result, "total_fare", digits=2)


def catalog_sum(spark: SparkSession, sf: str) -> DataFrame:
    """The same over a table that the catalog names."""
    table(spark, sf, "lineitem").createOrReplaceTempView("listed_lineitem")
    return steadied(gold.sum_by_key(read_table(spark, "listed_lineitem"), "l_suppkey", "l_extendedprice", "total_fare"), "total_fare", digits=2)


SUM_BY_KEY = """
SELECT l_suppkey, round(sum(l_extendedprice) + 1e-7, 2) AS total_fare FROM lineitem GROUP BY l_suppkey
"""


def keyword_score(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").withColumn("label", F.upper("p_name"))
    weights = [(["ring", "gear"], 5), (["bolt"], 4), (["red"], 3), (["small", "large"], 1)]
    return op.keyword_score(parts, "p_brand", "p_type", "label", weights, ("amenity_score", "core_amenity_score"))


KEYWORD_SCORE = """
SELECT p_brand, count(DISTINCT p_type) AS amenity_score,
       CAST(sum(CASE WHEN p_name LIKE '%ring%' OR p_name LIKE '%gear%' THEN 5 WHEN p_name LIKE '%bolt%' THEN 4
                     WHEN p_name LIKE '%red%' THEN 3 WHEN p_name LIKE '%small%' OR p_name LIKE '%large%' THEN 1
                     ELSE 0 END) AS BIGINT) AS core_amenity_score
FROM part GROUP BY p_brand
"""


def group_std(spark: SparkSession, sf: str) -> DataFrame:
    return steadied(_with_std(spark, sf), "std")


def _with_std(spark: SparkSession, sf: str, **options) -> DataFrame:
    group = F.when(F.col("event_id") == 3, F.lit(-1)).when(F.col("user_id") % 10 != 0, F.col("user_id"))
    events = table(spark, sf, "events").select("event_id", group.alias("sector"), "value")
    return op.group_std(events, "sector", "value", "std", ["event_id"], **options)


GROUP_STD = """
WITH grouped AS (
  SELECT event_id, value, CASE WHEN event_id = 3 THEN -1 WHEN user_id % 10 <> 0 THEN user_id END AS sector FROM events)
SELECT event_id, sector, value,
       round(CASE WHEN sector IS NULL THEN 0 ELSE coalesce(stddev_samp(value) OVER (PARTITION BY sector), 0) END
             + 1e-7, 4) AS std
FROM grouped
"""


def sample_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = _with_std(spark, sf)
    order = [F.desc_nulls_last("value"), F.col("event_id").asc()]
    return features.sample_report(rows.withColumn("std", F.col("std") * 1000), order, ["event_id", "value", "std"], "std")


SAMPLE_REPORT = """
WITH grouped AS (
  SELECT event_id, value, CASE WHEN event_id = 3 THEN -1 WHEN user_id % 10 <> 0 THEN user_id END AS sector FROM events),
spread AS (
  SELECT event_id, value, 1000 * CASE WHEN sector IS NULL THEN 0 ELSE coalesce(stddev_samp(value) OVER (PARTITION BY sector), 0) END AS std
  FROM grouped)
SELECT event_id, value, format('{:,}', CAST(round(std) AS BIGINT)) AS std
FROM spread ORDER BY value DESC, event_id LIMIT 20
"""

# ---- joins ---------------------------------------------------------------------------------------------------


def subdivision_metrics(spark: SparkSession, sf: str) -> DataFrame:
    subdivisions = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("project_id"),
        F.col("s_nationkey").alias("min_prop_per_floor"), F.col("s_suppkey").cast("int").alias("max_prop_per_floor"),
        F.col("s_acctbal").alias("number_ele_min"), F.nullif("s_acctbal", F.lit(73.0)).alias("number_ele_max"),
        F.lit(2.0).alias("number_living_floor"),
    )
    projects = table(spark, sf, "nation").where(F.col("n_regionkey") != 2).select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
        F.concat(F.lit("D"), "n_regionkey").alias("district"), F.lower("n_name").alias("province"),
    )
    return steadied(gold.subdivision_metrics(subdivisions, projects), "avg_ele")


SUBDIVISION_METRICS = """
SELECT s_suppkey AS subdivision_id, s_name AS subdivision_name, s_nationkey AS project_id, n_name AS project_name,
       'D' || n_regionkey AS district, lower(n_name) AS province, (s_nationkey + s_suppkey) / 2.0 AS avg_prop_per_floor,
       round((s_acctbal + nullif(s_acctbal, 73.0)) / 2 + 1e-7, 4) AS avg_ele, CAST(2.0 AS DOUBLE) AS number_living_floor
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_regionkey <> 2
"""


def _wide_join(spark: SparkSession, sf: str, **options) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_returnflag") != "A", F.col("l_partkey")).alias("part"),
    )
    parts = table(spark, sf, "part").where(F.col("p_size") > 10).select(
        F.col("p_partkey").alias("part"), "p_name", "p_brand", "p_type", F.col("p_retailprice").alias("price")
    )
    suppliers = table(spark, sf, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    scores = table(spark, sf, "orders").groupBy(F.col("o_orderkey").alias("l_orderkey")).agg(
        F.max("o_totalprice").alias("score")
    ).where(F.col("score") > 200000)
    unique = ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate"]

    def counts(key: str) -> dict:
        return {"stored": lines.select(key), **options}

    wide = op.join_exclude(lines, parts, "part", ["p_type"], unique, **counts("part"))
    wide = op.join_exclude(wide, suppliers, "l_suppkey", ["s_nationkey"], unique[:2], **counts("l_suppkey"))
    wide = op.lookup_join(wide, scores, "l_orderkey", ["l_linenumber", "part"], **counts("l_orderkey"))
    return wide.withColumn("score", F.coalesce("score", F.lit(0.0))).drop("l_shipdate")


WIDE_FEATURE_JOIN = """
SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice AS price,
       CASE WHEN l_returnflag <> 'A' THEN l_partkey END AS part, p_name, p_brand, p_retailprice AS price_1, s_name, s_acctbal,
       CASE WHEN o_totalprice > 200000 THEN o_totalprice ELSE 0.0 END AS score
FROM lineitem
LEFT JOIN part ON l_partkey = p_partkey AND l_returnflag <> 'A' AND p_size > 10
LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN orders ON l_orderkey = o_orderkey
"""


def wide_feature_join(spark: SparkSession, sf: str) -> DataFrame:
    return _wide_join(spark, sf)


def hot_key_join(spark: SparkSession, sf: str) -> DataFrame:
    """The same joins with keys of more than 20 rows cut into parts."""
    return _wide_join(spark, sf, hot_rows=20)


# ---- dedupe --------------------------------------------------------------------------------------------------


def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    dated = table(spark, sf, "orders").withColumn(
        "o_orderdate", F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate"))
    )
    return op.latest_per_key(dated, ["o_custkey"], ["o_orderdate", "o_orderkey"])


LATEST_PER_KEY = """
WITH dated AS (
  SELECT * REPLACE (CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS o_orderdate) FROM orders),
best AS (
  SELECT o_custkey, arg_max(o_orderkey, (coalesce(o_orderdate, DATE '0001-01-01'), o_orderkey)) AS o_orderkey
  FROM dated GROUP BY o_custkey)
SELECT dated.* FROM dated SEMI JOIN best USING (o_custkey, o_orderkey)
"""


def any_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return op.one_per_key(table(spark, sf, "part"), ["p_brand"], ["p_partkey"])


ANY_PER_KEY = """
SELECT part.* FROM part SEMI JOIN (SELECT min(p_partkey) AS p_partkey FROM part GROUP BY p_brand) AS k USING (p_partkey)
"""


def incremental_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("id", F.concat("user_id", F.lit("/"), F.floor("value")))
    batch = events.where(F.col("event_type") != "purchase").select("id", "ts", "event_id", "value")
    history = events.where(F.col("event_type") == "purchase")
    folder = f"{shared_folder(spark)}/seen-{uuid4().hex}"
    for part in (0, 1):  # two runs, most of whose ids are the same
        add_keys(history.where(F.col("event_id") % 2 == part), folder, "id", buckets=8)
    return op.new_rows(batch, stored_keys(spark, folder, "id"), "id", ["ts", "event_id"], long_history=True).select("id", "event_id", "value")


INCREMENTAL_NEW_ROWS = """
WITH e AS (SELECT *, user_id || '/' || CAST(floor(value) AS BIGINT) AS id FROM events)
SELECT id, arg_min(event_id, (ts, event_id)) AS event_id, arg_min(value, (ts, event_id)) AS value
FROM e WHERE event_type <> 'purchase' AND id NOT IN (SELECT id FROM e WHERE event_type = 'purchase')
GROUP BY id
"""


def early_stop(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        F.floor(F.col("event_id") / 100).alias("page"),
        "event_id",
        F.concat("user_id", F.lit("-"), "event_type").alias("id"),
    )
    history = events.where(F.col("id").startswith("1-")).select("id")
    return op.prefix_until_stale(events, history, "page", ["event_id"], "id", first_page=0)


EARLY_STOP = """
WITH e AS (SELECT event_id // 100 AS page, event_id, user_id || '-' || event_type AS id FROM events),
firsts AS (SELECT min(event_id) AS event_id FROM e WHERE id NOT LIKE '1-%' GROUP BY id),
fresh AS (SELECT e.* FROM e SEMI JOIN firsts USING (event_id)),
stop AS (SELECT min(page) AS page FROM (SELECT DISTINCT page FROM e UNION SELECT max(page) + 1 FROM e) AS p
         WHERE page NOT IN (SELECT page FROM fresh))
SELECT page, event_id, id FROM fresh WHERE page < (SELECT page FROM stop)
"""

# ---- pivot and sort ------------------------------------------------------------------------------------------

MONTHS = [f"price_{year}_{month:02d}" for year in range(1992, 2003) for month in range(1, 13)]


def pivot_prices(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").join(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey"
    )
    series = orders.select(
        "c_nationkey",
        "o_orderkey",
        "o_totalprice",
        F.year("o_orderdate").alias("year"),
        F.when(F.col("o_orderstatus") != "P", F.month("o_orderdate")).alias("month"),
    )
    found = set(op.series_keys(series, "year", "month"))
    pivoted = op.pivot_series(series, "c_nationkey", "year", "month", "o_totalprice", "o_orderkey")
    # The SQL names its columns beforehand: months without an order are empty there, and one it does not know would be a column too many.
    return pivoted.withColumns({name: F.lit(None).cast("double") for name in MONTHS if name not in found})


PIVOT_PRICES = """
WITH series AS (
  SELECT c_nationkey, o_orderkey, o_totalprice,
         'price_' || year(o_orderdate) || '_' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS k
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P')
SELECT c_nationkey, {columns} FROM series GROUP BY c_nationkey
""".format(columns=", ".join(f"arg_max(o_totalprice, o_orderkey) FILTER (WHERE k = '{m}') AS {m}" for m in MONTHS))


def handover_timeline(spark: SparkSession, sf: str) -> DataFrame:
    projects = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("district"), F.col("o_custkey").alias("province"),
        F.lit("dev").alias("developer_name"),
        F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")).alias("handover_date_from"),
    )
    return gold.project_handover_timeline(projects)


HANDOVER_TIMELINE = """
SELECT o_orderkey AS project_id, o_orderpriority AS project_name, o_orderstatus AS district, o_custkey AS province,
       'dev' AS developer_name, CAST(o_orderdate AS DATE) AS handover_date_from
FROM orders WHERE o_orderstatus <> 'P' ORDER BY handover_date_from, project_id
"""

def range_order(spark: SparkSession, sf: str) -> DataFrame:
    """Place of each order in a total order: rows of the partitions before its own, and its place there."""
    orders = table(spark, sf, "orders")
    priority = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    wide = orders.select("o_orderkey", priority.alias("priority"), "o_totalprice")
    ordered = op.range_order(wide, wide, {"priority": True, "o_orderkey": False}, rows_per_part=2_000)
    part, row = F.spark_partition_id(), F.monotonically_increasing_id()
    placed = cut_lineage(ordered.withColumns({"part": part, "place": row - F.shiftleft(part.cast("long"), 33)}))
    sizes = placed.groupBy("part").count()  # one row per partition
    before = F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = placed.join(sizes.select("part", before.alias("before")), "part")
    return found.select("o_orderkey", "priority", (F.col("before") + F.col("place") + 1).alias("position"))


RANGE_ORDER = """
WITH wide AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority FROM orders)
SELECT *, row_number() OVER (ORDER BY priority DESC NULLS LAST, o_orderkey) AS position FROM wide
"""

CHECKS = {
    "q_range_order": Check(range_order, RANGE_ORDER),
    "q_price_by_area": Check(price_by_area, PRICE_BY_AREA),
    "q_conditional_counts": Check(conditional_counts, CONDITIONAL_COUNTS),
    "q_area_bins": Check(area_bins, AREA_BINS),
    "q_price_history_monthly": Check(price_history_monthly, PRICE_HISTORY_MONTHLY),
    "q_developer_pricing": Check(developer_pricing, DEVELOPER_PRICING),
    "q_left_join_count": Check(left_join_count, LEFT_JOIN_COUNT),
    "q_median_boxplot": Check(median_boxplot, MEDIAN_BOXPLOT),
    "q_median_large_groups": Check(median_large_groups, MEDIAN_LARGE_GROUPS),
    "q_subdivision_metrics": Check(subdivision_metrics, SUBDIVISION_METRICS),
    "q_handover_timeline": Check(handover_timeline, HANDOVER_TIMELINE),
    "q_geo_heatmap": Check(geo_heatmap, GEO_HEATMAP),
    "q_top_areas": Check(top_areas, TOP_AREAS),
    "q_sum_by_key": Check(sum_by_key, SUM_BY_KEY),
    "q_catalog_sum": Check(catalog_sum, SUM_BY_KEY),
    "q_keyword_score": Check(keyword_score, KEYWORD_SCORE),
    "q_pivot_prices": Check(pivot_prices, PIVOT_PRICES),
    "q_wide_feature_join": Check(wide_feature_join, WIDE_FEATURE_JOIN),
    "q_hot_key_join": Check(hot_key_join, WIDE_FEATURE_JOIN),
    "q_group_std": Check(group_std, GROUP_STD),
    "q_sample_report": Check(sample_report, SAMPLE_REPORT),
    "q_latest_per_key": Check(latest_per_key, LATEST_PER_KEY),
    "q_any_per_key": Check(any_per_key, ANY_PER_KEY),
    "q_incremental_new_rows": Check(incremental_new_rows, INCREMENTAL_NEW_ROWS),
    "q_early_stop": Check(early_stop, EARLY_STOP),
}
