"""Warehouse-side queries: full load, first load, schema alignment, insert-only merge,
event-driven (streaming) load, part-path parsing."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.functions.paths import part_number, part_table_name
from clickflow.operators import export as ex
from clickflow.operators import warehouse as wh
from clickflow.plans.q_export import (NUMBERED, QUERY_CHUNK, STD, first_half, first_half_cutoff,
                                      std_raw, with_tags)
from clickflow.plans.registry import register
from clickflow.session import work_path
from clickflow.sources import fixtures as fx
from clickflow.sources.fixtures import with_fixtures
from clickflow.streaming.load import load_available


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _exported(spark, d) -> str:
    root = work_path(spark, "parts")
    with ex.numbered_rows(std_raw(spark, d), "_id", out="_rn") as numbered:   # cached for the export only
        ex.export_parts(numbered.withColumn("part_number", ex.chunk_column("_rn", QUERY_CHUNK)).drop("_rn"), root, "raw_data")
    return root


TARGET_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("collection", T.StringType()),
    T.StructField("user_id_db", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("is_paypal", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("loaded_by", T.StringType()),
])


@register("load_parts", with_fixtures(f"WITH {STD} SELECT * FROM std", "raw_data"))
def q_load_parts(spark, d):
    """OP-06/47: truncate-and-load the warehouse table from all parts (glob source)."""
    root = _exported(spark, d)
    target = _name("raw_data_full")
    wh.load_full(spark, root, ["raw_data"], {"raw_data": work_path(spark, target)}, {"raw_data": target})
    return spark.table(target)


@register("row_count", with_fixtures(
    "SELECT 'raw_data' AS table_name, 'loaded' AS status, count(*) AS rows, CAST(NULL AS VARCHAR) AS error "
    "FROM raw_data", "raw_data"))
def q_row_count(spark, d):
    """OP-31: load report with the loaded table's row count."""
    root = _exported(spark, d)
    target = _name("raw_data_count")
    return wh.load_full(spark, root, ["raw_data"], {"raw_data": work_path(spark, target)}, {"raw_data": target})


@register("first_load", with_fixtures(f"WITH {STD} SELECT * FROM std", "raw_data"))
def q_first_load(spark, d):
    """OP-48: target absent -> created from the staged rows."""
    target = _name("raw_data_first")
    wh.create_from(std_raw(spark, d), target, work_path(spark, target))
    return spark.table(target)


@register("align_schema", with_fixtures(
    "SELECT _id, collection, TRY_CAST(user_id_db AS BIGINT) AS user_id_db, TRY_CAST(price AS DOUBLE) AS price, "
    "CAST(is_paypal AS VARCHAR) AS is_paypal, ts, CAST(NULL AS VARCHAR) AS loaded_by FROM raw_data", "raw_data"))
def q_align_schema(spark, d):
    """OP-46: rows aligned to a target schema (order, types via try_cast, missing -> null)."""
    aligned, _lost = wh.align_to(fx.raw_data(spark, d), TARGET_SCHEMA)
    return aligned


@register("merge_insert_only", with_fixtures(f"WITH {STD} SELECT * FROM std", "raw_data"))
def q_merge_insert_only(spark, d):
    """OP-23: target holds the first half; merging every row inserts only new keys."""
    raw = fx.raw_data(spark, d)
    cutoff = first_half_cutoff(raw)
    from clickflow.operators.standardize import standardize
    target = _name("raw_data_merge")
    wh.create_from(standardize(with_tags(first_half(raw, cutoff))), target, work_path(spark, target))
    source = std_raw(spark, d)
    new = wh.merge_insert_only(spark.table(target), source, "_id")
    wh.append_rows(wh.align_to(new, spark.table(target).schema)[0], target)
    return spark.table(target)


@register("stream_load", with_fixtures(f"WITH {STD} SELECT * FROM std", "raw_data"))
def q_stream_load(spark, d):
    """OP-07/49: parts arrive as files; a stream stages each batch, creates the target
    on the first and merges the rest (availableNow trigger)."""
    root = _exported(spark, d)
    target = _name("raw_data_stream")
    load_available(spark, root, "raw_data", target, work_path(spark, target),
                   work_path(spark, target + "_ckpt"), max_files_per_trigger=64)
    return spark.table(target)


@register("parse_part_path", with_fixtures(
    f"WITH {STD}, {NUMBERED} SELECT 'raw_data' AS table_name, part_number, count(*) AS rows "
    "FROM numbered GROUP BY part_number", "raw_data"))
def q_parse_part_path(spark, d):
    """Table name and part number from each part file's path; rows per part."""
    root = _exported(spark, d)
    files = spark.read.parquet(f"{root}/raw_data").select(F.col("_metadata.file_path").alias("path"))
    return (files.select(part_table_name("path").alias("table_name"), part_number("path").alias("part_number"))
            .groupBy("table_name", "part_number").agg(F.count(F.lit(1)).alias("rows")))


def _part_rows(table: str, key: str, sql: str) -> str:
    return (f"SELECT '{table}' AS table_name, CAST(floor((row_number() OVER (ORDER BY {key}) - 1) / {QUERY_CHUNK}) "
            f"AS INTEGER) + 1 AS part_number, {key} AS k FROM ({sql}) z")


def _export_all_sql() -> str:
    from clickflow.plans.registry import REGISTRY
    raw = with_fixtures("SELECT _id FROM raw_data", "raw_data")
    parts = " UNION ALL ".join([
        _part_rows("raw_data", "_id", raw),
        _part_rows("product_names", "product_id", REGISTRY["clean_products"].sql),
        _part_rows("ip_locations", "ip", REGISTRY["ip_locations"].sql),
    ])
    return (f"SELECT table_name, part_number, count(*) AS rows, min(k) AS first_id, max(k) AS last_id "
            f"FROM ({parts}) p GROUP BY table_name, part_number")



def q_export_all_tables(spark, d):
    """OP-45c/45d over the three exported tables, each ordered by its own key."""
    from clickflow.operators import quality as dq
    from clickflow.plans.multi_table import export_tables
    from clickflow.plans.q_capture import _validated_success
    from clickflow.plans.q_geo import _validated
    root = work_path(spark, "export-all")
    products, _ = dq.split_valid(_validated_success(spark, d))
    locations, _ = dq.split_valid(_validated(spark, d))
    return export_tables(spark, {"raw_data": (std_raw(spark, d), "_id"),
                                 "product_names": (products, "product_id"),
                                 "ip_locations": (locations, "ip")}, root, size=QUERY_CHUNK)


def _load_all_sql() -> str:
    from clickflow.plans.registry import REGISTRY
    raw = with_fixtures("SELECT _id FROM raw_data", "raw_data")
    parts = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'loaded' AS status, count(*) AS rows, CAST(NULL AS VARCHAR) AS error "
        f"FROM ({sql}) z"
        for t, sql in (("raw_data", raw), ("product_names", REGISTRY["clean_products"].sql),
                       ("ip_locations", REGISTRY["ip_locations"].sql)))
    return parts


def q_load_all_tables(spark, d):
    """OP-47 over the three exported tables: truncate-and-load each from its parts; the
    report has one row per table (a failing table would not stop the others)."""
    from clickflow.operators import quality as dq
    from clickflow.plans.multi_table import export_tables
    from clickflow.plans.q_capture import _validated_success
    from clickflow.plans.q_geo import _validated
    root = work_path(spark, "load-all")
    products, _ = dq.split_valid(_validated_success(spark, d))
    locations, _ = dq.split_valid(_validated(spark, d))
    export_tables(spark, {"raw_data": (std_raw(spark, d), "_id"), "product_names": (products, "product_id"),
                          "ip_locations": (locations, "ip")}, root, size=QUERY_CHUNK)
    tables = ["raw_data", "product_names", "ip_locations"]
    names = {t: _name(t) for t in tables}
    return wh.load_full(spark, root, tables, {t: work_path(spark, names[t]) for t in tables}, names)
