"""Export-side queries: standardise, order, chunk, write parts, watermark state.

Test queries use parts of QUERY_CHUNK rows so that the sf0.01 tables span several
parts; the export default stays 250,000."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.operators import export as ex
from clickflow.operators import standardize as st
from clickflow.operators.events import slice_after
from clickflow.plans.registry import register
from clickflow.session import work_path
from clickflow.sources import fixtures as fx
from clickflow.sources.fixtures import with_fixtures

QUERY_CHUNK = 1000


def with_tags(raw: DataFrame) -> DataFrame:
    """raw_data plus one nested column (list of structs), as mixed documents have."""
    return raw.withColumn("tags", F.array(F.struct(F.col("cat_id").alias("k"), F.col("store_id").alias("v"))))


def std_raw(spark, d) -> DataFrame:
    return st.standardize(with_tags(fx.raw_data(spark, d)))


def epoch_micros(c: str = "ts"):
    """Microseconds since 1970-01-01 of a timestamp_ntz, independent of the session time
    zone (no cast through a zoned timestamp)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, F.col(c))


def first_half_cutoff(raw: DataFrame) -> int:
    """Middle of the event-time span in epoch microseconds (one scalar)."""
    us = epoch_micros("ts")
    row = raw.agg(F.floor((F.min(us) + F.max(us)) / 2).cast("bigint").alias("c")).first()
    return int(row["c"])


def first_half(raw: DataFrame, cutoff: int) -> DataFrame:
    return raw.where(epoch_micros("ts") <= F.lit(cutoff))


STD_COLS = ("_id, collection, product_id, viewing_product_id, current_url, referrer_url, ip, user_id_db, "
            "device_id, store_id, api_version, price, coalesce(CAST(cat_id AS VARCHAR), '') AS cat_id, "
            "coalesce(CAST(is_paypal AS VARCHAR), '') AS is_paypal, ts, "
            "CAST(to_json([{'k': cat_id, 'v': store_id}]) AS VARCHAR) AS tags")
STD = f"std AS (SELECT {STD_COLS} FROM raw_data)"
PART = f"CAST(floor((row_number() OVER (ORDER BY _id) - 1) / {QUERY_CHUNK}) AS INTEGER) + 1"
NUMBERED = f"numbered AS (SELECT *, {PART} AS part_number FROM std)"
CUT = "cut AS (SELECT CAST(floor((min(epoch_us(ts)) + max(epoch_us(ts))) / 2) AS BIGINT) AS c FROM raw_data)"
TWO_RUNS = f"""{CUT},
 r1 AS (SELECT _id, {PART} AS part_number FROM raw_data, cut WHERE epoch_us(ts) <= c),
 p1 AS (SELECT max(part_number) AS mp, max(_id) AS wm FROM r1),
 r2 AS (SELECT _id, {PART} + mp AS part_number FROM raw_data, p1 WHERE _id > wm),
 allp AS (SELECT * FROM r1 UNION ALL SELECT * FROM r2)"""
MANIFEST = "SELECT part_number, count(*) AS rows, min(_id) AS first_id, max(_id) AS last_id FROM {src} GROUP BY part_number"


@register("standardize", with_fixtures(f"WITH {STD} SELECT * FROM std", "raw_data"))
def q_standardize(spark, d):
    """OP-34: forced string columns, nested -> JSON, typed columns untouched."""
    return std_raw(spark, d)


@register("nested_to_json", with_fixtures(
    "SELECT _id, CAST(to_json([{'k': cat_id, 'v': store_id}]) AS VARCHAR) AS tags FROM raw_data", "raw_data"))
def q_nested_to_json(spark, d):
    """OP-34a: JSON text of a nested column (null fields kept)."""
    return st.nested_to_json(with_tags(fx.raw_data(spark, d)).select("_id", "tags"))


_DN = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS non_null, "
    f"count(*) FILTER (WHERE json_valid({c}) AND regexp_matches(trim({c}), '^[\\[{{]')) AS nested_values FROM events"
    for c in ("event_type", "props"))


@register("detect_nested", f"SELECT *, nested_values > 0 AS is_nested FROM ({_DN}) z")
def q_detect_nested(spark, d):
    """OP-34b: which string columns hold JSON arrays/objects (every row inspected)."""
    return st.detect_nested(fx.table(spark, d, "events"))


_SAMPLED = ("collection", "product_id", "ip", "price", "is_paypal", "tags")
_SAMPLE = " UNION ALL ".join(f"SELECT _id, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM std" for c in _SAMPLED)


@register("sample_columns", with_fixtures(
    f"""WITH std AS (SELECT _id, collection, product_id, ip, price, CAST(is_paypal AS VARCHAR) AS is_paypal,
  CAST(to_json([{{'k': cat_id, 'v': store_id}}]) AS VARCHAR) AS tags FROM raw_data),
 cells AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY md5(_id || '|' || column_name), value) AS place
  FROM ({_SAMPLE}) z WHERE value IS NOT NULL)
 SELECT column_name, CAST(place AS INTEGER) AS place, value FROM cells WHERE place <= 50""", "raw_data"))
def q_sample_columns(spark, d):
    """OP-39: 50 non-null values of six columns (one nested), the same rows on every run."""
    return st.sample_columns(with_tags(fx.raw_data(spark, d)), _SAMPLED, 50, key="_id")


@register("ordered_export", with_fixtures(
    "SELECT _id, row_number() OVER (ORDER BY _id) AS row_number FROM raw_data", "raw_data"))
def q_ordered_export(spark, d):
    """OP-37: global position in _id order (range-partitioned, no single-task sort)."""
    return ex.row_numbers(fx.raw_data(spark, d).select("_id"), "_id")


@register("assign_chunks", with_fixtures(f"SELECT _id, {PART} AS part_number FROM raw_data", "raw_data"))
def q_assign_chunks(spark, d):
    """OP-35: part number per row, QUERY_CHUNK rows per part in _id order."""
    return ex.assign_chunks(fx.raw_data(spark, d).select("_id"), "_id", QUERY_CHUNK)


@register("chunk_manifest", with_fixtures(
    f"WITH numbered AS (SELECT _id, {PART} AS part_number FROM raw_data) " + MANIFEST.format(src="numbered"),
    "raw_data"))
def q_chunk_manifest(spark, d):
    """OP-38: per part its row count and first/last _id."""
    return ex.chunk_manifest(ex.assign_chunks(fx.raw_data(spark, d).select("_id"), "_id", QUERY_CHUNK))


@register("watermark_slice", with_fixtures(
    f"SELECT _id, collection FROM raw_data WHERE _id > "
    f"(SELECT max(_id) FROM (SELECT _id, {PART} AS part_number FROM raw_data) z WHERE part_number = 1)",
    "raw_data"))
def q_watermark_slice(spark, d):
    """OP-11: rows above the watermark saved after part 1 (a literal, pushed to the scan)."""
    raw = fx.raw_data(spark, d)
    # last key of part 1 = largest of the first QUERY_CHUNK keys: a bounded top-k
    # (per-partition top-k, no full shuffle); the limit is the part size itself
    first_part = raw.select("_id").orderBy("_id").limit(QUERY_CHUNK)
    last_id = first_part.agg(F.max("_id")).first()[0]
    return slice_after(raw, "_id", last_id).select("_id", "collection")


@register("export_parts", with_fixtures(f"WITH {STD}, {NUMBERED} SELECT * FROM numbered", "raw_data"))
def q_export_parts(spark, d):
    """OP-45c: parts written by part number (dynamic overwrite) and read back."""
    root = work_path(spark, "export")
    numbered = ex.assign_chunks(std_raw(spark, d), "_id", QUERY_CHUNK)
    path = ex.export_parts(numbered, root, "raw_data")
    return spark.read.parquet(path)


@register("incremental_export", with_fixtures(f"WITH {TWO_RUNS} " + MANIFEST.format(src="allp"), "raw_data"))
def q_incremental_export(spark, d):
    """OP-45d: two export runs (first half of the time span, then everything); the second
    resumes after the saved watermark. Result: manifest of every part written."""
    root = work_path(spark, "incremental")
    raw = fx.raw_data(spark, d)
    cutoff = first_half_cutoff(raw)
    ex.incremental_export(spark, first_half(raw, cutoff), root, "raw_data", size=QUERY_CHUNK)
    ex.incremental_export(spark, raw, root, "raw_data", size=QUERY_CHUNK)
    return ex.chunk_manifest(spark.read.parquet(f"{root}/raw_data"))
