"""Text clean-up: Unicode-aware trim, title case, token dedupe, typo fixes and canonical composition."""

from __future__ import annotations

from unicodedata import normalize

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every character that counts as blank at the ends of a text.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}"
# Outside these two blocks a text may change under canonical composition; inside them it never does.
_MAY_COMPOSE = r"[^\u0000-\u02FF\u1E00-\u1EFF]"


def trim_unicode(text: Column) -> Column:
    """Cut every Unicode blank at both ends; ``trim`` alone cuts only plain spaces."""
    return F.btrim(text, F.lit(BLANKS))


def title_case(text: Column) -> Column:
    """Upper-case the first cased letter after any other character: ``grand-park s2a`` gives ``Grand-Park S2A``."""
    runs = F.regexp_extract_all(text, F.lit(rf"([{_CASED}]+|[^{_CASED}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def joined(items: Column, sep: str = ", ") -> Column:
    """Array to text; null items are skipped, an empty array gives an empty text, a null array stays null."""
    return F.array_join(items, sep)


def dedupe_tokens(text: Column, sep: str = ",") -> Column:
    """Keep the first copy of each trimmed, non-empty token, in order."""
    tokens = F.transform(F.split(text, sep), trim_unicode)
    return F.array_join(F.array_distinct(F.filter(tokens, lambda t: t != "")), ", ")


def fix_text(df: DataFrame, fixes: dict[str, str]) -> DataFrame:
    """Replace substrings in every string column, in the order given."""
    fixed = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            column = F.col(f"`{field.name}`")
            for wrong, right in fixes.items():
                column = F.replace(column, F.lit(wrong), F.lit(right))
            fixed[field.name] = column
    return df.withColumns(fixed)


@F.arrow_udf(T.StringType())
def _compose(batch: pa.Array) -> pa.Array:
    # Arrow's own utf8_normalize leaves decomposed Vietnamese letters as they are.
    return pa.array([None if text is None else normalize("NFC", text) for text in batch.to_pylist()], pa.string())


def nfc(text: Column) -> Column:
    """Canonical composition, which Spark SQL has no function for.

    Only texts that composition could change travel to the Arrow worker; all others are sent as nulls and kept.
    """
    composed = _compose(F.when(text.rlike(_MAY_COMPOSE), text))
    return F.coalesce(composed, text)
