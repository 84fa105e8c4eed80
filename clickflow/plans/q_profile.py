"""Profile queries: one-pass quality profile, its narrow parts, column catalogue."""

from __future__ import annotations

from clickflow.config import ProfileConfig
from clickflow.operators import profile as pf
from clickflow.plans.registry import register
from clickflow.sources import fixtures as fx
from clickflow.sources.fixtures import with_fixtures
from clickflow.sources.tables import RAW_DATA_SCHEMA


def _pct(col: str) -> str:
    return (f"CAST(round(CAST(count(*) FILTER (WHERE {col} IS NULL OR {col} = '') AS DECIMAL(38,0)) * 100 "
            f"/ CAST(nullif(count(*), 0) AS DECIMAL(38,0)), 2) AS DOUBLE)")


KEY = """count(*) AS total_rows, count(DISTINCT _id) AS distinct_id_count,
 CASE WHEN count(*) = count(DISTINCT _id) THEN 'Passed' ELSE 'Failed - Duplicated' END AS is_id_unique,
 count(*) FILTER (WHERE _id IS NULL) AS null_key_count"""
PROFILE = f"""SELECT {KEY},
 count(*) FILTER (WHERE user_id_db IS NULL OR user_id_db = '') AS null_user_id_db,
 {_pct('user_id_db')} AS null_pct_user_id_db,
 count(*) FILTER (WHERE device_id IS NULL OR device_id = '') AS null_device_id,
 count(DISTINCT device_id) AS distinct_devices, count(DISTINCT store_id) AS distinct_stores,
 count(DISTINCT api_version) AS distinct_api_versions,
 count(*) FILTER (WHERE price IS NULL OR price = '' OR price = '0') AS zero_or_null_price_count
FROM raw_data"""


@register("profile_raw", with_fixtures(PROFILE, "raw_data"))
def q_profile_raw(spark, d):
    """OP-32: the one-row quality profile of raw_data."""
    return pf.profile(fx.raw_data(spark, d), ProfileConfig())


@register("profile_parts", with_fixtures(
    """SELECT count(*) AS total_rows, count(*) FILTER (WHERE _id IS NULL) AS null_key_count,
 count(*) FILTER (WHERE user_id_db IS NULL OR user_id_db = '') AS null_user_id_db,
 count(*) FILTER (WHERE device_id IS NULL OR device_id = '') AS null_device_id,
 count(*) FILTER (WHERE price IS NULL OR price = '' OR price = '0') AS zero_or_null_price_count, 2 AS reads_of_new_parts FROM raw_data""", "raw_data"))
def q_profile_parts(spark, d):
    """OP-32 over arriving parts: profiled after each of two deliveries; the second reads the new parts only.
    The exact counts (the distinct counts carry the sketches' error and are tested apart)."""
    from pyspark.sql import functions as F
    from clickflow.operators.export import export_parts
    from clickflow.operators.part_profile import stored_profile, update_sketches
    from clickflow.session import work_path
    root, raw, reads = work_path(spark, "profiled"), fx.raw_data(spark, d), 0
    for late in (0, 1):
        part = raw.where(F.pmod(F.xxhash64("_id"), F.lit(2)) == late).withColumn("part_number", F.lit(late + 1))
        export_parts(part, root, "raw_data")
        reads += update_sketches(spark, root, "raw_data") > 0 and update_sketches(spark, root, "raw_data") == 0
    made = stored_profile(spark, root, "raw_data")
    return made.select("total_rows", "null_key_count", "null_user_id_db", "null_device_id", "zero_or_null_price_count", F.lit(reads).alias("reads_of_new_parts"))


@register("key_uniqueness", with_fixtures(f"SELECT {KEY} FROM raw_data", "raw_data"))
def q_key_uniqueness(spark, d):
    """OP-32 (narrow): key distinct count and uniqueness verdict."""
    return pf.key_uniqueness(fx.raw_data(spark, d), "_id")


@register("blank_rates", with_fixtures(
    "SELECT count(*) AS total_rows, "
    + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL OR {c} = '') AS null_{c}, {_pct(c)} AS null_pct_{c}"
                for c in ("user_id_db", "device_id")) + " FROM raw_data", "raw_data"))
def q_blank_rates(spark, d):
    """OP-32 (narrow): blank-or-null counts and percentages."""
    return pf.blank_rates(fx.raw_data(spark, d), ["user_id_db", "device_id"])


@register("distinct_counts", with_fixtures(
    "SELECT count(DISTINCT device_id) AS distinct_device_id, count(DISTINCT store_id) AS distinct_store_id, "
    "count(DISTINCT api_version) AS distinct_api_version FROM raw_data", "raw_data"))
def q_distinct_counts(spark, d):
    """OP-32 (narrow): exact distinct counts."""
    return pf.distinct_counts(fx.raw_data(spark, d), ["device_id", "store_id", "api_version"])


@register("zero_price", with_fixtures(
    "SELECT count(*) FILTER (WHERE price IS NULL OR price = '' OR price = '0') AS zero_or_null_price_count "
    "FROM raw_data", "raw_data"))
def q_zero_price(spark, d):
    """OP-32 (narrow): null, blank or '0' prices."""
    return pf.zero_counts(fx.raw_data(spark, d), ["price"])


_CAT = " UNION ALL ".join(
    f"SELECT 'raw_data' AS table_name, '{f.name}' AS column_name, '{f.dataType.simpleString().upper()}' AS data_type, "
    f"'YES' AS is_nullable, {i + 1} AS ordinal_position, count({f.name}) AS non_null_count FROM raw_data"
    for i, f in enumerate(RAW_DATA_SCHEMA.fields))


@register("catalog_columns", with_fixtures(f"SELECT * FROM ({_CAT}) z", "raw_data"))
def q_catalog_columns(spark, d):
    """OP-40: column catalogue (name, type, nullability, position) with non-null counts."""
    # Catalogue of the table as stored: its declared schema (every column nullable).
    return pf.catalog_columns({"raw_data": fx.raw_data(spark, d)}, {"raw_data": RAW_DATA_SCHEMA})


def _strings(*names: str):
    from pyspark.sql import types as T
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


PRODUCT_NAMES_SCHEMA = _strings("product_id", "product_name", "url")
IP_LOCATIONS_SCHEMA = _strings("ip", "country_short", "country_long", "region", "city")


def _cat_rows(table: str, cols: list[tuple[str, str]], sql: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{t}' AS data_type, 'YES' AS is_nullable, "
        f"{i + 1} AS ordinal_position, count({c}) AS non_null_count FROM ({sql}) z"
        for i, (c, t) in enumerate(cols))


def _catalog_all_sql() -> str:
    from clickflow.plans.registry import REGISTRY
    raw = with_fixtures("SELECT * FROM raw_data", "raw_data")
    parts = [
        _cat_rows("raw_data", [(f.name, f.dataType.simpleString().upper()) for f in RAW_DATA_SCHEMA.fields], raw),
        _cat_rows("product_names", [(c, "STRING") for c in ("product_id", "product_name", "url")],
                  REGISTRY["clean_products"].sql),
        _cat_rows("ip_locations", [(c, "STRING") for c in ("ip", "country_short", "country_long", "region", "city")],
                  REGISTRY["ip_locations"].sql),
    ]
    return " UNION ALL ".join(parts)


def q_catalog_all_tables(spark, d):
    """OP-40 over the three warehouse tables (raw_data, product_names, ip_locations)."""
    from clickflow.operators import quality as dq
    from clickflow.plans.q_capture import _validated_success
    from clickflow.plans.q_geo import _validated
    products, _ = dq.split_valid(_validated_success(spark, d))
    locations, _ = dq.split_valid(_validated(spark, d))
    schemas = {"raw_data": RAW_DATA_SCHEMA, "product_names": PRODUCT_NAMES_SCHEMA,
               "ip_locations": IP_LOCATIONS_SCHEMA}
    return pf.catalog_columns({"raw_data": fx.raw_data(spark, d), "product_names": products,
                               "ip_locations": locations}, schemas)
