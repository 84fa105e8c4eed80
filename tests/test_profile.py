"""One-pass profile and catalogue."""

from clickflow.config import ProfileConfig
from clickflow.operators import profile as pf
from conftest import rows

SCHEMA = "_id string, user_id_db string, device_id string, store_id string, api_version string, price string"


def test_profile_values(spark):
    df = spark.createDataFrame([
        ("1", "", "d1", "s1", "1.0", "0"),
        ("2", None, "d1", "s2", "1.0", "3.5"),
        ("3", "u", "", "s2", "2.0", ""),
        (None, " ", None, "s3", "2.0", None),          # whitespace is not blank (T33)
        ("3", "u", "d2", "s3", "2.0", "1"),
        ("4", "u", "d2", "s3", "2.0", "1"),
        ("5", "u", "d2", "s3", "2.0", "1"),
        ("6", "u", "d2", "s3", "2.0", "1"),
    ], SCHEMA)
    p = pf.profile(df, ProfileConfig()).first().asDict()
    assert p["total_rows"] == 8 and p["distinct_id_count"] == 6
    assert p["is_id_unique"] == "Failed - Duplicated" and p["null_key_count"] == 1      # T32
    assert p["null_user_id_db"] == 2 and p["null_pct_user_id_db"] == 25.0
    assert p["null_device_id"] == 2
    assert (p["distinct_devices"], p["distinct_stores"], p["distinct_api_versions"]) == (3, 3, 2)
    assert p["zero_or_null_price_count"] == 3


def test_profile_rounding_half_up_and_empty(spark):
    df = spark.createDataFrame([("1", "")] + [(str(i), "x") for i in range(2, 9)], "_id string, user_id_db string")
    r = pf.blank_rates(df, ["user_id_db"]).first()
    assert r["null_pct_user_id_db"] == 12.5
    df3 = spark.createDataFrame([("1", ""), ("2", "x"), ("3", "x")], "_id string, user_id_db string")
    assert pf.blank_rates(df3, ["user_id_db"]).first()["null_pct_user_id_db"] == 33.33
    empty = spark.createDataFrame([], "_id string, user_id_db string")
    assert pf.blank_rates(empty, ["user_id_db"]).first()["null_pct_user_id_db"] is None      # T34


def test_profile_approximate(spark):
    df = spark.range(5000).selectExpr("cast(id as string) as _id", "cast(id % 97 as string) as device_id",
                                      "'s' as store_id", "'1' as api_version", "'' as user_id_db", "'1' as price")
    p = pf.profile(df, ProfileConfig(approximate=True, rsd=0.01)).first()
    # within 3 standard deviations of the requested 1% error
    assert abs(p["distinct_id_count"] - 5000) <= 150 and abs(p["distinct_devices"] - 97) <= 3


def test_catalog_columns(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "x string, y bigint")
    got = rows(pf.catalog_columns({"t": df}))
    assert got == [("t", "x", "STRING", "YES", 1, 1), ("t", "y", "BIGINT", "YES", 2, 2)]


def test_catalog_columns_from_catalog_table(spark):
    import uuid
    from clickflow.session import work_path
    name = f"t_cat_{uuid.uuid4().hex[:8]}"
    spark.createDataFrame([("a", 1)], "x string, y bigint").write.option("path", work_path(spark, name)).saveAsTable(name)
    got = rows(pf.catalog_columns({"t": name}, spark=spark), "column_name", "non_null_count")
    assert got == [("x", 1), ("y", 1)]


def test_profile_matches_pandas_on_fixture(spark):
    from decimal import ROUND_HALF_UP, Decimal

    from clickflow.sources import fixtures as fx
    from conftest import SF_SMALL
    raw = fx.raw_data(spark, SF_SMALL)
    pdf = raw.select("_id", "user_id_db", "device_id", "store_id", "api_version", "price").toPandas()
    blank = lambda c: pdf[c].isna() | (pdf[c] == "")
    n = len(pdf)
    exp = {
        "total_rows": n,
        "distinct_id_count": pdf["_id"].nunique(),
        "null_user_id_db": int(blank("user_id_db").sum()),
        "null_pct_user_id_db": float((Decimal(int(blank("user_id_db").sum())) * 100 / Decimal(n))
                                     .quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)),
        "null_device_id": int(blank("device_id").sum()),
        "distinct_devices": pdf["device_id"].nunique(),
        "distinct_stores": pdf["store_id"].nunique(),
        "distinct_api_versions": pdf["api_version"].nunique(),
        "zero_or_null_price_count": int((blank("price") | (pdf["price"] == "0")).sum()),
    }
    got = pf.profile(raw, ProfileConfig()).first().asDict()
    assert {k: got[k] for k in exp} == exp
    assert got["is_id_unique"] == ("Passed" if exp["distinct_id_count"] == n else "Failed - Duplicated")
