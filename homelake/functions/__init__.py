"""Column expressions.  All run inside the JVM except Unicode composition (see ``text.nfc``)."""

from homelake.functions.choice import contains_any, encode, first_match, flag, lowered
from homelake.functions.dates import epoch_day_text, lenient_date
from homelake.functions.documents import bound, compact, is_container, is_json, json_objects, last_of_each_key, parse_whole
from homelake.functions.numeric import midpoint, nth, round_to, round_to_grid, safe_div
from homelake.functions.text import dedupe_tokens, fix_text, joined, nfc, title_case, trim_unicode
from homelake.functions.views import with_view_category

__all__ = [
    "bound", "compact", "contains_any", "dedupe_tokens", "encode", "epoch_day_text", "first_match", "fix_text", "flag", "is_container", "is_json",
    "joined", "json_objects", "last_of_each_key", "lenient_date", "lowered", "midpoint", "nfc", "nth", "parse_whole", "round_to", "round_to_grid", "safe_div", "title_case",
    "trim_unicode", "with_view_category",
]
