"""Category of a listing's free-text view description."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homelake.functions.choice import contains_any
from homelake.functions.text import dedupe_tokens, nfc, title_case, trim_unicode

# Labels, words and their priority define the categories and must stay as they are.
UNKNOWN_VIEW = "Không Xác Định"
OTHER_VIEW = "Khác"
CEMETERY_VIEW = "Nghĩa Trang / Khu Mộ"
CEMETERY_WORDS = ["nghĩa trang", "khu mộ"]
VIEW_TYPOS = {"nôi khu": "nội khu", "nộii khu": "nội khu"}
OUTSIDE_PATTERN = r"(?Ud)ngoại khu\s*\((.*?)\)"
# A text of fewer than two word characters, or of nothing but k, says nothing.
TWO_WORD_CHARS = r"[\p{L}\p{N}_][^\p{L}\p{N}_]*[\p{L}\p{N}_]"
WORD_CHAR_BUT_K = r"[\p{L}\p{N}_&&[^k]]"
VIEW_LABELS = [
    ("hồ", "Hồ"),
    ("công viên", "Công Viên"),
    ("thành phố", "Thành Phố"),
    ("trường học", "Trường Học"),
    ("nội khu", "Nội Khu"),
]


def with_view_category(df: DataFrame, source: str, out: str) -> DataFrame:
    """Add ``out``, the category of ``source``; texts no rule knows are deduplicated and title-cased.

    The cleaned text is staged in its own projection because every rule reads it.
    """
    clean = "__view_clean"
    text = trim_unicode(F.lower(nfc(F.col(source))))
    for wrong, right in VIEW_TYPOS.items():
        text = F.replace(text, F.lit(wrong), F.lit(right))
    text = F.regexp_replace(text, OUTSIDE_PATTERN, "$1")

    value = F.col(clean)
    says_something = value.rlike(TWO_WORD_CHARS) & value.rlike(WORD_CHAR_BUT_K)
    category = (
        F.when(F.col(source).isNull() | (trim_unicode(F.col(source)) == ""), UNKNOWN_VIEW)
        .when(contains_any(value, CEMETERY_WORDS), CEMETERY_VIEW)
        .when(~says_something, OTHER_VIEW)
    )
    for needle, label in VIEW_LABELS:
        category = category.when(value.contains(needle), label)
    return (
        df.withColumn(clean, text)
        .withColumn(out, category.otherwise(title_case(dedupe_tokens(value))))
        .drop(clean)
    )
