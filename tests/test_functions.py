import json
import random
import time
import unicodedata

import pytest
from pyspark.sql import functions as F

from homelake import functions as fn


def evaluate(spark, column, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("v"))).collect()]


TEXTS = [
    "  grand-park s2a ", "o'neil MCDONALD", "căn hộ ", " đÔNG nam　", "", None, "a1b2 c_d", "日本a b", "ßa ǆa",
    unicodedata.normalize("NFD", "thổ cư nội khu"), "x\x1cy\x1f", "ﬁne ŉ", "ΌΣΟΣ ς",
]


def test_title_case_and_trim_follow_python(spark):
    expected = [None if t is None else t.strip().title() for t in TEXTS]
    assert evaluate(spark, lambda c: fn.title_case(fn.trim_unicode(c)), TEXTS) == expected


def test_nfc_follows_python(spark):
    texts = [*TEXTS, "é", "가", "Å", "plain"]
    expected = [None if t is None else unicodedata.normalize("NFC", t) for t in texts]
    assert evaluate(spark, fn.nfc, texts) == expected


@pytest.mark.parametrize("value, label", [
    (None, "Không Xác Định"), ("  ", "Không Xác Định"), (" ", "Không Xác Định"), ("K", "Khác"), ("k, k", "Khác"),
    ("?!", "Khác"), ("Ngoại khu (Hồ bơi)", "Hồ"), (unicodedata.normalize("NFD", "Ngoại khu (Hồ bơi)"), "Hồ"),
    ("nghĩa trang, công viên", "Nghĩa Trang / Khu Mộ"), ("đất trống, đất trống", "Đất Trống"), ("nôi khu", "Nội Khu"),
    ("nộii khu", "Nội Khu"), ("thành phố, công viên", "Công Viên"), ("Trường Học x", "Trường Học"),
    ("ngoại khu (sông) , ngoại khu  (núi), sông", "Sông, Núi"), ("a,,b , a", "A, B"), ("kk1", "Kk1"),
])
def test_view_category(spark, value, label):
    frame = spark.createDataFrame([(value,)], "v string")
    assert fn.with_view_category(frame, "v", "c").first()["c"] == label


def test_rounding_casts_tie_to_even(spark):
    values = [2.5, 3.5, -2.5, 0.5, None, 1e15]
    assert evaluate(spark, lambda c: fn.round_to(c, "bigint"), values, "double") == [2, 4, -2, 0, None, 10**15]


def test_nth_is_one_based_and_tolerant(spark):
    assert evaluate(spark, lambda c: fn.nth(c, 2), [[1.0], [1.0, 2.0], [], None], "array<double>") == [None, 2.0, None, None]


def test_lenient_date(spark):
    texts = ["2026-03-01", "2024-1-5", "2024-01-05T10:00:00Z", "2026", "2026-03", "", "soon", None, "2024-13-01", " 2024-02-03 "]
    found = [str(d) if d else None for d in evaluate(spark, fn.lenient_date, texts)]
    assert found == ["2026-03-01", "2024-01-05", "2024-01-05", None, None, None, None, None, None, "2024-02-03"]


def test_epoch_day(spark):
    assert evaluate(spark, fn.epoch_day_text, [0, 1706745599999, None], "bigint") == ["01-01-1970", "31-01-2024", None]


def test_joined_skips_nulls(spark):
    assert evaluate(spark, fn.joined, [["a", None, "b"], [], None], "array<string>") == ["a, b", "", None]


def test_grid_rounding_scales_first(spark):
    rng = random.Random(5)
    values = [1.0005, -1.0005, 2.5, 10.12345, 106.6665] + [rng.uniform(-180, 180) for _ in range(500)]

    def expected(v):
        scaled = v * 1000
        whole = int(abs(scaled))
        whole += abs(scaled) - whole >= 0.5
        return (whole if scaled >= 0 else -whole) / 1000

    assert evaluate(spark, lambda c: fn.round_to_grid(c, 3), values, "double") == [expected(v) for v in values]


def test_safe_div_and_flags(spark):
    assert evaluate(spark, lambda c: fn.safe_div(F.lit(1.0), c), [0.0, 4.0, None], "double") == [None, 0.25, None]
    assert evaluate(spark, lambda c: fn.flag(c > 1), [2, 1, None], "int") == [1, 0, 0]


def test_parse_whole_rejects_trailing_text(spark):
    texts = ['{"a":1}', '{"a":1} x', '{"a":1}{"b":2}', '1,2', "", None, "[1]", "{bad", '{"a":NaN}', '{"a":1,"a":2}']
    assert evaluate(spark, lambda c: fn.parse_whole(c, "struct<a:string>")["a"], texts) == [
        "1", None, None, None, None, None, None, None, '"NaN"', "2"]
    assert evaluate(spark, fn.is_json, texts) == [True, False, False, False, False, False, True, False, True, True]


def test_json_objects_and_repeated_keys(spark):
    texts = ['[{"a": 1}, 7, "x", {"b": [1, {"c": 2}]}, null]', "{}", "x", None, "[]"]
    items = evaluate(spark, lambda c: F.to_json(fn.json_objects(c)), texts)
    assert items == ['[{"pos":0,"item":"{\\"a\\":1}"},{"pos":3,"item":"{\\"b\\":[1,{\\"c\\":2}]}"}]', None, None, None, "[]"]
    last = evaluate(spark, lambda c: F.to_json(F.map_from_entries(fn.last_of_each_key(F.from_json(c, "map<string,variant>")))), ['{"a":1,"b":2,"a":3}'])
    assert last == ['{"b":2,"a":3}']


def test_the_last_of_repeated_keys_holds(spark):
    texts = ['{"a": 1, "b": 2, "a": 3, "c": 4, "b": null}', '{"a": 1, "c": 5}', "{}", "[1]", None, '{"é": 1, "é": 2}']
    rows = spark.createDataFrame([(text,) for text in texts], "t string")
    entries = rows.select(fn.last_of_each_key(F.from_json("t", "map<string,string>")).alias("e"))
    found = [None if r["e"] is None else [(e["key"], e["value"]) for e in r["e"]] for r in entries.collect()]
    assert found == [[("a", "3"), ("c", "4"), ("b", None)], [("a", "1"), ("c", "5")], [], None, None, [("é", "2")]]


def test_records_are_parsed_once_however_wide(spark):
    """Each parse of the wide object takes a tenth of a second; one per member would take hours."""
    from homelake.sources.embedded import _record

    wide = json.dumps({f"k{i}": i for i in range(100_000)})
    rows = spark.createDataFrame([(wide,), (wide[:-1] + ', "k7": "last"}',)], "t string")
    start = time.perf_counter()
    found = rows.select(_record(F.col("t"), ["k3"]).alias("r")).collect()
    assert time.perf_counter() - start < 20
    first, second = (json.loads(r["r"]) for r in found)
    assert len(first) == len(second) == 99_999 and "k3" not in second
    assert (first["k7"], second["k7"]) == (7, "last")


def test_records_of_usual_width_take_no_longer_than_a_filter(spark):
    from homelake.sources.embedded import _record

    members = F.concat_ws(",", *[F.format_string(f'"k{i}":"v%d"', F.col("id")) for i in range(61)])
    rows = spark.range(20_000).select(F.concat(F.lit("{"), members, F.lit("}")).alias("t")).persist()
    rows.count()

    def seconds(column):
        times = []
        for _ in range(4):
            start = time.perf_counter()
            rows.select(column).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        return min(times[1:])

    plain = F.to_json(F.map_filter(F.from_json("t", "map<string,variant>"), lambda name, _: name != "k3"))
    assert seconds(_record(F.col("t"), ["k3"])) < 3 * seconds(plain)  # 1.4 by itself; other work on the machine may come in between
    rows.unpersist()
