"""Sources: JSON-lines export with extended-JSON ids and mixed types, part globs."""

from pyspark.sql import functions as F

from clickflow.operators import candidates as cand
from clickflow.operators import standardize as st
from clickflow.sources.tables import read_json_events, read_parts
from clickflow.session import work_path


def test_json_export_with_oid_and_mixed_types(spark, tmp_path):
    lines = [
        '{"_id": {"$oid": "65A0000000000000000000B2"}, "collection": "view_product_detail", "product_id": 123, '
        '"viewing_product_id": "9", "current_url": "https://w/1", "price": 12.5, "cat_id": [1, 2], "is_paypal": true}',
        '{"_id": {"$oid": "65a0000000000000000000b1"}, "collection": "view_product_detail", "product_id": "abc", '
        '"current_url": "https://w/2", "price": "0", "cat_id": "7", "is_paypal": "yes", "extra": {"x": 1}}',
        '{"_id": "plain-id", "collection": "other"}',
    ]
    p = tmp_path / "raw.jsonl"
    p.write_text("\n".join(lines) + "\n")
    df = read_json_events(spark, str(p))
    got = {r["_id"]: r for r in df.collect()}
    assert set(got) == {"65a0000000000000000000b2", "65a0000000000000000000b1", "plain-id"}
    a = got["65a0000000000000000000b2"]
    # a nested value in a text field keeps its source JSON text
    assert (a["product_id"], a["price"], a["cat_id"], a["is_paypal"]) == ("123", "12.5", "[1, 2]", "true")
    assert got["65a0000000000000000000b1"]["price"] == "0"
    assert got["65a0000000000000000000b1"]["is_paypal"] == "yes"        # mixed type kept as text
    # the capture path runs on it directly
    c = cand.candidates(df)
    assert sorted(r[0] for r in c.select("product_id").collect()) == ["123", "abc"]
    assert st.detect_nested(df, ["cat_id"]).first()["nested_values"] == 1


def test_read_parts_merge_schema(spark):
    root = work_path(spark, "t-parts")
    spark.createDataFrame([("1", 1)], "_id string, a int").write.parquet(f"{root}/t/part_number=1")
    spark.createDataFrame([("2", "x")], "_id string, b string").write.parquet(f"{root}/t/part_number=2")
    merged = read_parts(spark, root, "t", merge_schema=True)
    assert set(merged.columns) == {"_id", "a", "b", "part_number"}
    assert merged.count() == 2
    assert merged.where(F.col("part_number") == 2).first()["b"] == "x"


def test_read_source_generic_and_missing_connector(spark):
    import pytest
    from clickflow.sources.tables import read_source
    path = work_path(spark, "t-src")
    spark.createDataFrame([("1", "view_product_detail")], "_id string, collection string").write.orc(path)
    assert read_source(spark, "orc", path).count() == 1
    with pytest.raises(RuntimeError, match="not available"):
        read_source(spark, "no.such.connector", uri="x://y").count()


def test_json_values_that_do_not_convert_keep_their_events(spark, tmp_path):
    from datetime import datetime

    from clickflow.sources.tables import read_bad_json
    noon = datetime(2024, 1, 2, 12, 0, 0)
    values = {
        "iso": ('"2024-01-02T12:00:00.000000"', noon), "zone": ('"2024-01-02T14:00:00+02:00"', noon), "z": ('"2024-01-02T12:00:00Z"', noon),
        "date": ('{"$date": "2024-01-02T12:00:00Z"}', noon), "millis": ('{"$date": 1704196800000}', noon),
        "long": ('{"$date": {"$numberLong": "1704196800000"}}', noon), "old": ('{"$date": {"$numberLong": "-86400000"}}', datetime(1969, 12, 31)),
        "second": ('{"$date": 1000}', datetime(1970, 1, 1, 0, 0, 1)), "early": ('{"$date": 86400000}', datetime(1970, 1, 2)), "s": ("1704196800", noon), "ms": ("1704196800000", noon),
        "stamp": ('{"$timestamp": {"t": 1704196800, "i": 1}}', noon), "day": ('"2024-01-02"', datetime(2024, 1, 2)),
        "us": ('"2024-01-02T12:00:00.123456Z"', datetime(2024, 1, 2, 12, 0, 0, 123456)),
        "huge": ("1e30", None), "text": ('"02/01/2024 noon"', None), "null": ("null", None), "flag": ("true", None), "list": ("[1]", None)}
    bad = ['{"_id": "cut", "ts": ', "no json", '{"_id": "x" "ts": 1}', "5"]
    lines = [f'{{"_id": "{k}", "collection": "c", "ts": {v}}}' for k, (v, _) in values.items()] + ['{"_id": "twice", "_id": "twice"}']
    p = tmp_path / "e.jsonl"
    p.write_text("\n".join(lines[:5] + bad + ["", "  "] + lines[5:]) + "\n")
    events = read_json_events(spark, str(p))
    assert {r["_id"]: r["ts"] for r in events.collect()} == {k: v for k, (_, v) in values.items()} | {"twice": None}
    assert events.count() == len(lines)
    assert sorted(r["line"] for r in read_bad_json(spark, str(p)).collect()) == sorted(bad)
    assert read_bad_json(spark, str(p)).count() == len(bad)
