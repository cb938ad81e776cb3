"""Physical plans of the operators that have to scale."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from homelake import operators as op
from homelake.checks import CHECKS
from homelake.checks.common import table
from homelake.plans import gold

SF = "/root/testdata/sf0.001"
# Only composing view texts needs a Python worker; tables that carry views inherit it.
USES_VIEWS = {"q_categorize_text", "silver_properties", "gold_features", "gold_features_sample"}


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", CHECKS)
def test_no_cross_join_and_no_row_wise_python(spark, name):
    text = plan(CHECKS[name].run(spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "FlatMapGroupsInPandas" not in text
    if name not in USES_VIEWS:
        assert "ArrowEvalPython" not in text


def test_one_row_per_key_is_limited_before_the_exchange(spark):
    orders = table(spark, SF, "orders")
    for result in (op.latest_per_key(orders, ["o_custkey"], ["o_orderdate"]), op.one_per_key(orders, ["o_custkey"])):
        text = plan(result)
        assert re.search(r"WindowGroupLimit.*\n(.*\n)*.*Exchange.*\n(.*\n)*.*WindowGroupLimit", text)


def test_summaries_read_only_their_columns(spark, tmp_path):
    columns = "id string, district string, ward string, min_selling_price bigint, max_selling_price bigint, other string"
    spark.createDataFrame([("1", "d", "w", 1, 2, "x")], columns).write.parquet(f"{tmp_path}/properties")
    text = plan(gold.price_by_ward(spark.read.parquet(f"{tmp_path}/properties")))
    assert "PushedFilters: [IsNotNull(min_selling_price)]" in text
    assert "other" not in text
    assert text.count("partial_count") == 1


def test_wide_listings_are_shuffled_once_per_join_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(CHECKS["gold_features"].run(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = re.findall(r"^\(\d+\) (?:SortMergeJoin|ShuffledHashJoin).*\n(?:.*\n)*?\n", text, flags=re.M)
    on_listings = [j for j in joins if "LeftOuter" in j]
    assert len(on_listings) == 2


def test_median_reads_its_source_twice(spark):
    text = plan(op.exact_median(table(spark, SF, "orders"), ["o_custkey"], F.col("o_totalprice"), "m"))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, flags=re.M)) == 2 and "Union" not in text


def test_top_k_keeps_only_the_best_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan(gold.top_areas(table(spark, SF, "orders"), ["o_custkey"], "o_totalprice"))


def test_monthly_means_send_no_side_to_the_driver(spark):
    series = spark.createDataFrame([("a", 1, 2.0), ("a", 1, None), ("b", 1, 4.0), ("c", 1, 9.0), (None, 1, 7.0)], "key string, month int, price double")
    groups = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "x"), ("d", None)], "key string, area string")
    found = gold.monthly_means(series, "key", ["month"], {"mean": "price"}, groups, ["area"])
    assert "Broadcast" not in plan(found) and "SortMergeJoin" in plan(found)
    assert [tuple(row) for row in found.collect()] == [("x", 1, 10 / 3)]
