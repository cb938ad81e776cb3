"""Total order of a wide table by split points taken from a narrow stored one."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_PART = 1_000_000
SAMPLED_PER_PART = 100
_PART = "__part"


def range_order(
    df: DataFrame, stored: DataFrame, descending: dict[str, bool], rows_per_part: int = ROWS_PER_PART
) -> DataFrame:
    """``df`` in order of the columns of ``descending`` (text or numbers; missing values last if descending, else first), one range per partition.

    The split points come from ``stored``, which holds the same columns for the same rows, so ``df`` is computed once: ``orderBy`` would
    run it a second time to sample it.  The sample on the driver is about ``SAMPLED_PER_PART`` narrow rows per range.  The points set only
    the layout; a value that fills several ranges is split by the columns after it.
    """
    order = [F.desc_nulls_last(c) if down else F.asc_nulls_first(c) for c, down in descending.items()]
    points = split_points(stored.select(*descending), order, rows_per_part)
    ranged = df.withColumn(_PART, range_number(points, df, descending))
    return ranged.repartitionById(len(points) + 1, _PART).sortWithinPartitions(*order).drop(_PART)


def split_points(narrow: DataFrame, order: list[Column], rows_per_part: int) -> list[list]:
    rows = narrow.count()
    parts = -(-rows // rows_per_part)
    if parts <= 1:
        return []
    sample = narrow.sample(min(1.0, SAMPLED_PER_PART * parts / rows), seed=7).orderBy(*order).collect()
    places = sorted({len(sample) * i // parts for i in range(1, parts)})
    return [list(sample[place]) for place in places if place < len(sample)]


def range_number(points: list[list], df: DataFrame, descending: dict[str, bool]) -> Column:
    """How many split points stand at or before a row, by binary search."""
    if not points:
        return F.lit(0)
    names = list(descending)
    fields = ",".join(f"f{i}:{df.schema[name].dataType.simpleString()}" for i, name in enumerate(names))
    listed = json.dumps([{f"f{i}": value for i, value in enumerate(point)} for point in points], ensure_ascii=False)
    bounds = F.from_json(F.lit(listed), f"array<struct<{fields}>>")

    def reached(point: Column) -> Column:
        same, before = [], []
        for i, name in enumerate(names):
            bound, here = point[f"f{i}"], F.col(name)
            if descending[name]:
                first = (bound > here) | (bound.isNotNull() & here.isNull())
            else:
                first = (bound < here) | (bound.isNull() & here.isNotNull())
            before.append(reduce(lambda a, b: a & b, [*same, F.coalesce(first, F.lit(False))]))
            same.append(bound.eqNullSafe(here))
        return reduce(lambda a, b: a | b, [*before, reduce(lambda a, b: a & b, same)])

    def step(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        middle = F.shiftright(low + high, 1)
        upper = reached(F.get(bounds, middle))
        halved = F.struct(F.when(upper, middle + 1).otherwise(low).alias("low"), F.when(upper, high).otherwise(middle).alias("high"))
        return F.when(low < high, halved).otherwise(state)

    start = F.struct(F.lit(0).alias("low"), F.lit(len(points)).alias("high"))
    steps = F.sequence(F.lit(1), F.lit(len(points).bit_length()))
    return F.aggregate(steps, start, step, lambda state: state["low"])
