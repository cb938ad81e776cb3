"""Records embedded as JSON in web pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homelake.functions import is_json, json_objects, last_of_each_key, parse_whole

# Where the records sit in a page, and the bulky keys that are not kept.
SCRIPT_ID = "__NEXT_DATA__"
RECORDS_PATH = "props.pageProps.fallback"
MEDIA_KEYS = ["urls", "galleries", "image_urls", "images"]


def script_text(html: Column, script_id: str = SCRIPT_ID) -> Column:
    """Content of the first script tag with this id outside comments; empty text when the page has none."""
    # Scripts are matched whole, so a comment mark inside one is text, and a script inside a comment goes with it.
    visible = F.regexp_replace(html, r"(?is)(<script\b.*?</script)|<!--.*?(?:-->|\z)", "$1")
    tag = rf"""(?is)<script(?=[^>]*\sid\s*=\s*["']?(?-i:\Q{script_id}\E)["']?[\s>])[^>]*>(.*?)</script"""
    return F.regexp_extract(visible, tag, 1)


def drop_keys(json_text: Column, keys: list[str]) -> Column:
    """Remove top-level keys from a JSON object of unknown shape; null when the text is no object."""
    members = F.from_json(json_text, "map<string,variant>")
    return F.to_json(F.map_filter(members, lambda name, _: ~name.isin(keys)))


def _record(item: Column, without: list[str]) -> Column:
    """An object without the given keys; one that cannot be taken apart below its members stays as delivered."""
    entries = last_of_each_key(F.from_json(item, "map<string,variant>"))
    kept = F.filter(entries, lambda entry: ~entry["key"].isin(without))
    return F.coalesce(F.to_json(F.map_from_entries(kept)), item)


def unreadable_pages(pages: DataFrame, page_col: str, html_col: str, script_id: str = SCRIPT_ID) -> DataFrame:
    """(page, script) of the pages whose data script is no valid JSON."""
    scripts = pages.select(page_col, script_text(F.col(html_col), script_id).alias("script"))
    return scripts.where((F.trim("script") != "") & ~is_json(F.col("script")))


def extract_embedded_json(
    pages: DataFrame,
    page_col: str,
    html_col: str,
    script_id: str = SCRIPT_ID,
    root_path: str = RECORDS_PATH,
    without: list[str] | None = None,
) -> DataFrame:
    """Records of each page in source order: (page, entry_pos, item_pos, record as JSON text).

    Every member of the object at ``root_path`` contributes its ``data`` list or else its ``data.items`` list.  Of a repeated key the
    last value holds.  Members of another shape, list items that are no objects, pages without the script and pages whose script is no
    valid JSON (see :func:`unreadable_pages`) contribute nothing.
    """
    shape = "map<string,string>"
    for name in reversed(root_path.split(".")):
        shape = f"struct<`{name}`:{shape}>"
    scripts = pages.select(page_col, script_text(F.col(html_col), script_id).alias("script"))
    root = parse_whole(F.col("script"), shape)
    for name in root_path.split("."):
        root = root[name]
    # A map keeps the members in source order; a variant object would sort them by name.
    members = scripts.select(page_col, root.alias("members"))
    entries = members.select(page_col, F.posexplode(last_of_each_key(F.col("members"))).alias("entry_pos", "entry"))
    data = entries.select(page_col, "entry_pos", F.from_json(F.col("entry.value"), "data string")["data"].alias("data"))
    items = F.coalesce(json_objects(F.col("data")), json_objects(F.from_json("data", "items string")["items"]))
    records = data.select(page_col, "entry_pos", F.explode(items).alias("found"))
    return records.select(
        page_col, "entry_pos", F.col("found.pos").alias("item_pos"),
        _record(F.col("found.item"), MEDIA_KEYS if without is None else without).alias("record"),
    )
