"""JSON text.

The variant parser refuses an object that repeats a key, ``NaN`` and values beyond its size limit.  Ordinary JSON readers accept these (the last
of repeated keys holds), so texts are taken apart with Spark's JSON reader, which hands on each member as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_whole(text: Column, shape: str) -> Column:
    """The text read as ``shape`` (a type in SQL), or null when it is not exactly one JSON value.

    Spark's reader stops after the first value and accepts what follows; inside brackets it cannot.
    """
    values = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{shape}>")
    return F.when(F.size(values) == 1, F.get(values, F.lit(0)))


def is_json(text: Column) -> Column:
    """Whether the text is exactly one JSON value."""
    return F.coalesce(F.size(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")) == 1, F.lit(False))


def json_objects(list_text: Column) -> Column:
    """Texts of the objects in a JSON list, as structs (pos, item) in order; other elements are left out."""
    items = F.transform(F.from_json(list_text, "array<string>"), lambda item, pos: F.struct(pos.alias("pos"), item.alias("item")))
    return F.filter(items, lambda entry: F.coalesce(entry["item"].startswith("{"), F.lit(False)))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, however often and wherever ``use`` mentions it.

    A column expression inside a lambda is computed anew for every element; a lambda's own variable is not.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def last_of_each_key(members: Column) -> Column:
    """Entries (key, value) of a map read from JSON, where a repeated key keeps its last value.

    The map is read once.  Where no key repeats, which one hash pass over the keys tells, its entries are handed on; else keys
    are sorted with their places, and the last place of each key is kept.
    """

    def last(entries: Column) -> Column:
        placed = F.sort_array(F.transform(entries, lambda entry, at: F.struct(entry["key"].alias("key"), at.alias("at"))))
        lasts = bound(placed, lambda of: F.filter(of, lambda one, at: ~one["key"].eqNullSafe(F.get(of, at + 1)["key"])))
        return F.transform(F.sort_array(lasts["at"]), lambda at: F.get(entries, at))

    def cleaned(entries: Column) -> Column:
        keys = entries["key"]
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), entries).otherwise(last(entries))

    return bound(F.map_entries(members), cleaned)


def compact(text: Column) -> Column:
    """The value in Spark's own notation; a text that the variant parser refuses stays as it is."""
    return F.coalesce(F.to_json(F.try_parse_json(text)), text)


def is_container(text: Column) -> Column:
    return F.coalesce(text.startswith("{") | text.startswith("["), F.lit(False))
