"""Pattern matches with their places, from DataFrame functions only.

``regexp_extract_all`` gives the matches and ``split`` the text between them, so running sums of both lengths are the offsets; the ends of the
text before and after a match are its context.  One pass over a text per pattern, linear in its length.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT = 40
_CHUNK = 256
_SPAN = "struct<start:int,end:int,value:string,before:string,after:string>"


class Pattern(NamedTuple):
    """A kind of match: Java pattern, and which matches count (the others are dropped, not retried)."""

    kind: str
    regex: str
    valid: Callable[[Column], Column] = lambda value: F.lit(True)


def _placed(values: Column, gaps: Column) -> Column:
    """Spans of the matches ``values`` between the pieces ``gaps``; in chunks, since appending copies an array."""
    steps = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _CHUNK).cast("int"))

    def one(acc: Column, i: Column) -> Column:
        gap, value = F.get(gaps, i), F.get(values, i)
        start = acc["at"] + F.length(gap)
        end = start + F.length(value)
        span = F.struct(start.alias("start"), end.alias("end"), value.alias("value"),
                        F.right(gap, F.lit(CONTEXT)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(1)).alias("after"))
        return F.struct(end.alias("at"), acc["whole"].alias("whole"), F.array_append(acc["own"], span).alias("own"))

    def chunk(acc: Column, step: Column) -> Column:
        numbers = F.sequence(step * _CHUNK, F.least((step + 1) * _CHUNK, F.size(values)) - 1)
        begin = F.struct(acc["at"].alias("at"), acc["whole"].alias("whole"), F.array().cast(f"array<{_SPAN}>").alias("own"))
        return F.aggregate(numbers, begin, one, lambda done: F.struct(
            done["at"].alias("at"), F.array_append(done["whole"], done["own"]).alias("whole")))

    nothing = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{_SPAN}>>").alias("whole"))
    return F.aggregate(steps, nothing, chunk, lambda done: F.flatten(done["whole"]))


def with_spans(docs: DataFrame, patterns: list[Pattern], text: str) -> DataFrame:
    """``docs`` with a column ``__span_<kind>`` per kind, an array of (start, end, value, before, after); text is read as empty where null."""
    content = F.coalesce(F.col(text), F.lit(""))
    found = docs.withColumns({f"__{p.kind}": F.regexp_extract_all(content, F.lit(p.regex), F.lit(0)) for p in patterns})
    # Columns of their own: inside a lambda the text would be split again for every match.
    found = found.withColumns({
        f"__gaps_{p.kind}": F.when(F.size(f"__{p.kind}") > 0, F.split(content, p.regex, -1)) for p in patterns
    })
    none = F.array().cast(f"array<{_SPAN}>")

    def placed(pattern: Pattern) -> Column:
        values = F.col(f"__{pattern.kind}")
        spans = F.filter(_placed(values, F.col(f"__gaps_{pattern.kind}")), lambda span: pattern.valid(span["value"]))
        return F.when(F.size(values) > 0, spans).otherwise(none)

    out = found.withColumns({f"__span_{p.kind}": placed(p) for p in patterns})
    return out.drop(*[f"__{p.kind}" for p in patterns], *[f"__gaps_{p.kind}" for p in patterns])


def span_text(spans: Column) -> Column:
    """kind:start:end of each span of an array, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
