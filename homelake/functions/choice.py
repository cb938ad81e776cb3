"""Choice expressions: first match wins, code tables and two-valued flags."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def lowered(text: Column) -> Column:
    """Lower case with missing read as empty, so that tests on it are never null."""
    return F.coalesce(F.lower(text), F.lit(""))


def contains_any(text: Column, words: str | Iterable[str]) -> Column:
    words = [words] if isinstance(words, str) else list(words)
    return reduce(lambda a, b: a | b, [text.contains(word) for word in words])


def first_match(text: Column, rules: Sequence[tuple[str | Sequence[str], object]], default: object) -> Column:
    """Value of the first rule one of whose words occurs in the text."""
    chosen = reduce(
        lambda chain, rule: chain.when(contains_any(text, rule[0]), F.lit(rule[1])),
        rules[1:],
        F.when(contains_any(text, rules[0][0]), F.lit(rules[0][1])),
    )
    return chosen.otherwise(F.lit(default))


def encode(value: Column, codes: dict[str, object], default: object) -> Column:
    """Exact look-up in a small code table."""
    table = F.create_map(*[F.lit(part) for pair in codes.items() for part in pair])
    return F.coalesce(F.try_element_at(table, value), F.lit(default))


def flag(condition: Column) -> Column:
    """1 or 0; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")
