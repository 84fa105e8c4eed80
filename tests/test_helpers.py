"""Smaller helpers: sampling, row count, per-file counts, state from a manifest."""

import uuid

from pyspark.sql import functions as F

from clickflow.operators import export as ex
from clickflow.operators import standardize as st
from clickflow.operators import warehouse as wh
from clickflow.session import work_path
from clickflow.streaming.load import part_files
from conftest import rows


def test_sample_non_null(spark):
    df = spark.createDataFrame([(None,), ("a",), ("b",), (None,), ("c",)], "x string")
    got = [r[0] for r in st.sample_non_null(df, "x", 2).collect()]
    assert len(got) == 2 and all(v is not None for v in got)


def test_row_count(spark):
    name = f"t_rc_{uuid.uuid4().hex[:8]}"
    spark.range(7).write.option("path", work_path(spark, name)).saveAsTable(name)
    assert wh.row_count(spark, name).first()["rows"] == 7


def test_part_files(spark):
    root = work_path(spark, "t-pf")
    df = spark.createDataFrame([(f"{i:03d}",) for i in range(30)], "_id string")
    ex.export_parts(ex.assign_chunks(df, "_id", 10), root, "tbl")
    pf = part_files(spark.read.parquet(f"{root}/tbl").withColumn("_source_file", F.col("_metadata.file_path")))
    got = pf.groupBy("table_name").agg(F.sum("rows").alias("n")).collect()
    assert [(r["table_name"], r["n"]) for r in got] == [("tbl", 30)]


def test_save_state_from_manifest_and_numbered_rows(spark):
    root = work_path(spark, "t-state")
    df = spark.createDataFrame([(f"{i:03d}",) for i in range(25)], "_id string")
    manifest = ex.chunk_manifest(ex.assign_chunks(df, "_id", 10, start=3), "_id")
    ex.save_state(manifest, root, "t")
    assert ex.load_state(spark, root, "t") == ("024", 5)
    with ex.numbered_rows(df, "_id", 4) as rn:
        assert rows(rn.where(F.col("row_number") <= 2), "_id", "row_number") == [("000", 1), ("001", 2)]
