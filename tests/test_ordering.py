"""Total order by split points of a narrow table."""

import random

import pytest
from pyspark.sql import functions as F

from homelake.operators import range_order
from tests.test_plans import plan

ORDER = {"day": True, "id": False}


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    # One day holds half of all rows; days and ids may be missing, and rows repeat.
    data = [(rng.choice(["05", "05", "05", None, "01", "02", 'q"\'é']), rng.choice([None, *map(str, range(400))]), i) for i in range(2000)]
    return spark.createDataFrame(data, "day string, id string, n int").repartition(5).cache()


@pytest.mark.parametrize("rows_per_part", [37, 400, 10**6])
def test_partitions_one_after_the_other_are_in_order(spark, rows, rows_per_part):
    found = range_order(rows, rows, ORDER, rows_per_part)
    wanted = rows.orderBy(F.desc_nulls_last("day"), F.asc_nulls_first("id")).collect()
    assert [(r["day"], r["id"]) for r in found.collect()] == [(r["day"], r["id"]) for r in wanted]
    assert sorted(r["n"] for r in found.collect()) == list(range(2000)) and found.columns == rows.columns
    sizes = [r[0] for r in found.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) < 4 * max(rows_per_part, 100) and len(sizes) > 2000 / rows_per_part / 4


def test_the_table_is_computed_once(spark, rows):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    wide = rows.mapInPandas(counted, rows.schema)
    found = range_order(wide, rows, ORDER, 100)
    assert "rangepartitioning" not in plan(found) and "from_json" not in plan(found)
    found.write.format("noop").mode("overwrite").save()
    assert seen.value == 2000


def test_empty_and_numeric(spark):
    empty = spark.createDataFrame([], "day string, id string")
    assert range_order(empty, empty, ORDER, 10).count() == 0
    numbers = spark.range(500).select(((F.col("id") * 37) % 500).alias("v"), (F.col("id") / 3).alias("w"))
    assert [r["v"] for r in range_order(numbers, numbers, {"v": True, "w": False}, 60).collect()] == list(range(499, -1, -1))
