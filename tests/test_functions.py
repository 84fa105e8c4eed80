"""Column helpers: paths, strip, truthiness."""

from pyspark.sql import functions as F

from clickflow.functions.paths import part_number, part_table_name, staging_name
from clickflow.functions.text import first_truthy, is_blank, strip_ws
from conftest import rows


def test_part_paths(spark):
    df = spark.createDataFrame([
        ("gs://b/raw/raw_data/raw_data_part_12.parquet",),
        ("/w/export/ip_locations/part_number=3/part-00001-abc.c000.snappy.parquet",),
        ("/w/raw/product_names_part_x.parquet",),
        ("/w/notes.txt",),
    ], "p string")
    got = rows(df.select("p", part_table_name("p").alias("t"), part_number("p").alias("n"),
                         staging_name("p").alias("s")))
    assert got == [
        ("/w/export/ip_locations/part_number=3/part-00001-abc.c000.snappy.parquet", "ip_locations", 3,
         "part-00001-abc.c000.snappy"),
        ("/w/notes.txt", None, None, "notes.txt"),
        ("/w/raw/product_names_part_x.parquet", "product_names", None, "product_names_temp_part_x"),
        ("gs://b/raw/raw_data/raw_data_part_12.parquet", "raw_data", 12, "raw_data_temp_part_12"),
    ]


def test_strip_and_blank(spark):
    df = spark.createDataFrame([("\t a b \n",), (" x ",), ("   ",), ("",), (None,)], "s string")
    got = [r[0] for r in df.select(strip_ws("s")).collect()]
    assert got == ["a b", "x", "", "", None]
    assert [r[0] for r in df.select(is_blank("s")).collect()] == [False, False, False, True, True]


def test_first_truthy(spark):
    df = spark.createDataFrame([("", "b"), (None, "b"), ("a", "b"), ("", ""), ("0", "x")], "a string, b string")
    assert [r[0] for r in df.select(first_truthy("a", "b")).collect()] == ["b", "b", "a", None, "0"]
    nums = spark.createDataFrame([(0, 5), (3, 5), (None, 0)], "a bigint, b bigint")
    got = [r[0] for r in nums.select(first_truthy("a", "b", types={"a": nums.schema["a"].dataType,
                                                                   "b": nums.schema["b"].dataType})).collect()]
    assert got == ["5", "3", None]
