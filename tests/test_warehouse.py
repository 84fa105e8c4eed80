"""Schema alignment, insert-only merge, first/full load."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.operators import export as ex
from clickflow.operators import warehouse as wh
from clickflow.session import work_path
from conftest import plan_text, rows, srt


def test_align_to(spark):
    df = spark.createDataFrame([("1", "12", "x", True), ("2", "oops", "y", None)],
                               "_id string, n string, extra string, flag boolean")
    target = T.StructType([T.StructField("n", T.LongType()), T.StructField("_id", T.StringType()),
                           T.StructField("flag", T.StringType()), T.StructField("missing", T.DoubleType())])
    aligned, lost = wh.align_to(df, target)
    assert aligned.schema == target or [f.name for f in aligned.schema.fields] == ["n", "_id", "flag", "missing"]
    assert lost == ["extra"]
    assert rows(aligned) == srt([(12, "1", "true", None), (None, "2", None, None)])


def test_merge_insert_only_semantics(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1)], "_id string, v int")
    source = spark.createDataFrame([("a", 2), ("c", 2), ("c", 3), (None, 4), (None, 5)], "_id string, v int")
    new = wh.merge_insert_only(target, source, "_id")
    # matched 'a' untouched, source duplicates and null keys all inserted (T28)
    assert rows(new) == srt([("c", 2), ("c", 3), (None, 4), (None, 5)])
    # dedupe_source keeps one row per key (the null-key group included)
    assert rows(wh.merge_insert_only(target, source, "_id", dedupe_source=True), "_id") == srt([("c",), (None,)])


def test_merge_twice_equals_once(spark):
    name = f"t_merge_{uuid.uuid4().hex[:8]}"
    path = work_path(spark, name)
    part = spark.createDataFrame([("a", 1), ("b", 2)], "_id string, v int")
    assert wh.load_part(part, name, path) == "created"
    part2 = spark.createDataFrame([("b", 9), ("c", 3)], "_id string, v int")
    assert wh.load_part(part2, name, path) == "merged"
    assert wh.load_part(part2, name, path) == "merged"
    assert rows(spark.table(name)) == [("a", 1), ("b", 2), ("c", 3)]


def test_merge_plan_keeps_target_unshuffled_for_bounded_source(spark):
    target = spark.range(1000).select(F.col("id").cast("string").alias("_id"))
    source = spark.createDataFrame([("5",), ("x",)], "_id string")
    text = plan_text(wh.merge_insert_only(target, source, "_id", source_is_bounded=True))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_load_full_isolates_failures(spark):
    root = work_path(spark, "t-full")
    df = spark.createDataFrame([(f"{i:04d}", i) for i in range(50)], "_id string, v int")
    ex.export_parts(ex.assign_chunks(df, "_id", 20), root, "good")
    name = f"t_good_{uuid.uuid4().hex[:8]}"
    rep = wh.load_full(spark, root, ["missing_table", "good"],
                       {"good": work_path(spark, name), "missing_table": work_path(spark, "x")},
                       {"good": name, "missing_table": f"t_missing_{uuid.uuid4().hex[:8]}"})
    got = {r["table_name"]: (r["status"], r["rows"]) for r in rep.collect()}
    assert got == {"missing_table": ("failed", None), "good": ("loaded", 50)}
    # a second full load replaces, it does not append
    wh.load_full(spark, root, ["good"], {"good": work_path(spark, name)}, {"good": name})
    assert spark.table(name).count() == 50


def test_merge_prunes_target_scan_by_source_key_range(spark):
    path = work_path(spark, "t-prune")
    spark.range(5000).select(F.format_string("%08d", "id").alias("_id")).write.parquet(path)
    source = spark.createDataFrame([("00000100",), ("00000200",), ("zzz",)], "_id string")
    target = spark.read.parquet(path)
    new = wh.merge_insert_only(target, source, "_id", prune_target=True)
    assert rows(new) == [("zzz",)]
    text = plan_text(new)
    assert "GreaterThanOrEqual(_id,00000100)" in text and "LessThanOrEqual(_id,zzz)" in text
    # same answer without pruning
    assert rows(wh.merge_insert_only(target, source, "_id")) == [("zzz",)]
