"""Rows, columns and tables that a second run must not lose."""

import os

from pyspark.sql import functions as F

from clickflow.operators import attempts as att
from clickflow.operators import export as ex
from clickflow.operators import warehouse as wh
from clickflow.session import work_path
from clickflow.sources.tables import read_bad_json, read_json_events, read_parts
from conftest import rows

import pytest


def _exported(spark, root, table, col):
    return rows(spark.read.option("mergeSchema", "true").parquet(f"{root}/{table}"), col)


def test_export_of_business_keys_loses_no_row(spark):
    root = work_path(spark, "t-loss")
    make = lambda ids: spark.createDataFrame([(i, f"n{i}") for i in ids], "product_id string, name string")
    run = lambda ids: ex.incremental_export(spark, make(ids), root, "p", "product_id", 2, arrival_ordered=False).count()
    run(["500", "900", None])
    run(["500", "900", None, "100", "700", "950"])
    assert _exported(spark, root, "p", "product_id") == rows(make(["100", "500", "700", "900", "950", None]), "product_id")
    assert run(["500", "100", None]) == 0


def test_watermark_export_keeps_null_keys_once(spark):
    root = work_path(spark, "t-null")
    make = lambda ids: spark.createDataFrame([(i, f"n{k}") for k, i in enumerate(ids)], "_id string, name string")
    for ids in (["a", "b"], ["a", "b", None, "c"], ["a", "b", None, "c"]):
        ex.incremental_export(spark, make(ids), root, "t", "_id", 10)
    assert rows(spark.read.parquet(f"{root}/t"), "_id", "name") == rows(make(["a", "b", None, "c"]), "_id", "name")


def test_state_commits_are_new_files(spark):
    root = work_path(spark, "t-state")
    ex.write_state(spark, root, "t", "k1", 1)
    ex.write_state(spark, root, "t", "k2", 12)
    assert ex.load_state(spark, root, "t") == ("k2", 12)
    ex.reset_state(spark, root, "t")
    assert ex.load_state(spark, root, "t") == (None, 0)


def test_failed_reload_keeps_the_table_and_later_columns_survive(spark):
    root, place, name = work_path(spark, "t-reload"), work_path(spark, "t-place"), "t_reload"
    spark.createDataFrame([("1", 1)], "_id string, a int").write.parquet(f"{root}/t/part_number=1")
    spark.createDataFrame([("2", "x")], "_id string, b string").write.parquet(f"{root}/t/part_number=2")
    load = lambda: wh.load_full(spark, root, ["t"], {"t": place}, {"t": name}).first()
    assert load()["status"] == "loaded"
    assert sorted(spark.table(name).columns) == ["_id", "a", "b"]
    broken = f"{root}/t/part_number=3".removeprefix("file:")
    os.makedirs(broken)
    with open(f"{broken}/part-0.parquet", "wb") as f:
        f.write(b"no parquet")
    assert load()["status"] == "failed" and spark.table(name).count() == 2
    spark.sql(f"DROP TABLE {name}")
    assert set(read_parts(spark, root + "/t/part_number=2").columns) == {"_id", "b"}


def test_strict_alignment_fails_and_lenient_counts(spark):
    df = spark.createDataFrame([("1", "12a"), ("2", "7")], "_id string, n string")
    target = spark.createDataFrame([], "_id string, n int").schema
    with pytest.raises(Exception, match="column n"):
        wh.align_to(df, target, "strict")[0].collect()
    assert rows(wh.align_to(df, target)[0]) == rows(spark.createDataFrame([("1", None), ("2", 7)], target))
    assert wh.nulled_values(df, target).first()["n"] == 1


def test_part_with_a_new_column_evolves_the_target(spark):
    name, place = "t_evolve", work_path(spark, "t-evolve")
    wh.load_part(spark.createDataFrame([("1", 1)], "_id string, a int"), name, place)
    wh.load_part(spark.createDataFrame([("2", 2, "x")], "_id string, a int, b string"), name, place)
    assert rows(spark.table(name), "_id", "b") == rows(spark.createDataFrame([("1", None), ("2", "x")], "_id string, b string"))
    spark.sql(f"DROP TABLE {name}")


def test_several_pages_make_one_log_row(spark):
    log = spark.createDataFrame([("1", "u", 2, 200, None)], "product_id string, url string, attempt int, status_code int, error_kind string")
    pages = spark.createDataFrame([("1", 1, "<h1 class='page-title'><span>old</span></h1>"),
                                   ("1", 2, "<h1 class='page-title'><span>new</span></h1>"),
                                   ("1", 2, "<p>none</p>")], "product_id string, attempt int, html string")
    got = att.result_log(att.resolve_attempts(log), pages).collect()
    assert [r["product_name"] for r in got] == ["new"]
    assert att.result_log(att.resolve_attempts(log), pages.drop("attempt")).count() == 1


def test_malformed_json_lines_are_quarantined(spark, tmp_path):
    p = tmp_path / "e.json"
    p.write_text('{"_id": {"$oid": "AAAAAAAAAAAAAAAAAAAAAAAA"}, "collection": "x"}\n{"broken": \n\n')
    assert read_json_events(spark, str(p)).select(F.col("_id")).collect()[0][0] == "a" * 24
    assert read_json_events(spark, str(p)).count() == 1
    assert [r["line"] for r in read_bad_json(spark, str(p)).collect()] == ['{"broken": ']
