from pyspark.sql import functions as F
from pyspark.sql import types as T

from homelake.operators import new_rows
from homelake.sources import read_entity
from homelake.streaming import new_records_query, read_new_records

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("seq", T.LongType())])


def drain(spark, source, target, checkpoint, **options):
    query = new_records_query(spark, f"{source}/properties*.jsonl", SCHEMA, target, checkpoint, "id", ["seq"], **options)
    query.awaitTermination()


def stored(spark, target):
    return sorted((r["id"], r["seq"]) for r in read_new_records(spark, target, SCHEMA).select("id", "seq").collect())


def test_stream_equals_batch_and_handles_only_new_files(spark, tmp_path, write_jsonl):
    source, target, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    source.mkdir()
    write_jsonl(source / "properties_1.jsonl", [{"id": "a", "seq": 2}, {"id": "a", "seq": 1}, {"id": "b", "seq": 3}, {"seq": 9}])
    drain(spark, source, target, checkpoint)
    assert stored(spark, target) == [("a", 1), ("b", 3)]

    write_jsonl(source / "properties_2.jsonl", [{"id": "b", "seq": 4}, {"id": "c", "seq": 6}, {"id": "c", "seq": 5}])
    drain(spark, source, target, checkpoint)
    drain(spark, source, target, checkpoint)
    everything = read_entity(spark, f"{source}/properties*.jsonl", SCHEMA).where(F.col("id").isNotNull())
    batch = new_rows(everything, everything.limit(0), "id", ["seq"])
    assert stored(spark, target) == sorted((r["id"], r["seq"]) for r in batch.collect()) == [("a", 1), ("b", 3), ("c", 5)]


def test_a_repeated_batch_replaces_its_first_attempt(spark, tmp_path):
    from homelake.streaming.incremental import _append_unseen, _open_target

    target = str(tmp_path / "out")
    _open_target(spark, target, SCHEMA)
    one = spark.createDataFrame([("a", 1), ("b", 2)], SCHEMA)
    two = spark.createDataFrame([("b", 3), ("c", 4)], SCHEMA)
    _append_unseen(one, 0, target, "id", ["seq"])
    _append_unseen(two, 1, target, "id", ["seq"])
    _append_unseen(two, 1, target, "id", ["seq"])
    assert stored(spark, target) == [("a", 1), ("b", 2), ("c", 4)]


def test_several_batches_in_one_run(spark, tmp_path, write_jsonl):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for n in range(4):
        write_jsonl(source / f"properties_{n}.jsonl", [{"id": "same", "seq": 10}, {"id": f"x{n}", "seq": n}])
    drain(spark, source, target, str(tmp_path / "cp"), max_files=1)
    assert stored(spark, target) == [("same", 10), ("x0", 0), ("x1", 1), ("x2", 2), ("x3", 3)]


def test_folders_do_not_grow_and_a_broken_off_batch_is_completed(spark, tmp_path):
    import os

    from homelake.streaming.incremental import _append_unseen, _open_target

    target = str(tmp_path / "out")
    _open_target(spark, target, SCHEMA)
    for number in range(4):
        _append_unseen(spark.createDataFrame([(f"x{number}", 1), ("same", number)], SCHEMA), number, target, "id", ["seq"], buckets=2)
        if not number:
            folders = [folder for folder, _, _ in os.walk(target)]
    assert [folder for folder, _, _ in os.walk(target)] == folders
    # A first attempt that left one of its records and no keys.
    spark.createDataFrame([("p", 1, 4)], "id string, seq long, batch_id long").write.mode("append").parquet(f"{target}/records")
    _append_unseen(spark.createDataFrame([("p", 1), ("q", 2), ("x1", 9)], SCHEMA), 4, target, "id", ["seq"])
    _append_unseen(spark.createDataFrame([("p", 8), ("q", 8)], SCHEMA), 5, target, "id", ["seq"])
    assert stored(spark, target) == [("p", 1), ("q", 2), ("same", 0), ("x0", 1), ("x1", 1), ("x2", 1), ("x3", 1)]
