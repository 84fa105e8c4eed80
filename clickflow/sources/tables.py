"""Readers. Each returns a lazy DataFrame; pruning and pushdown are left to Catalyst."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.functions.text import strip_ws

RAW_DATA_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("collection", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("viewing_product_id", T.StringType()),
    T.StructField("current_url", T.StringType()),
    T.StructField("referrer_url", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("user_id_db", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("store_id", T.StringType()),
    T.StructField("api_version", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("cat_id", T.StringType()),
    T.StructField("is_paypal", T.BooleanType()),
    T.StructField("ts", T.TimestampNTZType()),
])

# JSON exports: the mixed-type fields (forced to text at export) are read as text, so a
# value of an unexpected type is kept instead of becoming null.
RAW_JSON_SCHEMA = T.StructType([T.StructField(f.name, T.StringType() if f.name in ("is_paypal",) else f.dataType)
                                for f in RAW_DATA_SCHEMA.fields])

IP_RANGES_SCHEMA = T.StructType([
    T.StructField("ip_from", T.LongType()),
    T.StructField("ip_to", T.LongType()),
    T.StructField("country_short", T.StringType()),
    T.StructField("country_long", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("city", T.StringType()),
])

PAGES_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])


def read_events(spark: SparkSession, path: str, cols: Sequence[str] | None = None,
                groups: Sequence[str] | None = None, event_col: str = "collection",
                schema: T.StructType | None = None) -> DataFrame:
    """Event scan: optional projection and event-name predicate (both reach the scan)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    if groups:
        df = df.where(F.col(event_col).isin(list(groups)))
    if cols:
        df = df.select(*cols)
    return df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Full scan of one table, all fields."""
    return spark.read.parquet(path)


def read_parts(spark: SparkSession, root: str, table: str | None = None,
               merge_schema: bool = True) -> DataFrame:
    """All Parquet parts of one table below ``root/<table>`` (any depth). Columns that first
    appear in a later part are kept (null in the parts before)."""
    path = f"{root.rstrip('/')}/{table}" if table else root
    return (spark.read.option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "false")
            .option("mergeSchema", str(bool(merge_schema)).lower())
            .parquet(path))


def _exists(spark: SparkSession, path: str) -> bool:
    from clickflow.sources.fs import exists
    return exists(spark, path)


def read_finished_ids(spark: SparkSession, *paths: str) -> DataFrame:
    """Finished-id text files (one id per line). Missing files count as empty; lines are
    stripped and blank lines dropped; the union is deduplicated."""
    present = [p for p in paths if _exists(spark, p)]
    if not present:
        return spark.createDataFrame([], "product_id string")
    return (spark.read.text(present)
            .select(strip_ws("value").alias("product_id"))
            .where(F.col("product_id") != "")
            .distinct())


def read_ip_ranges(spark: SparkSession, path: str, fmt: str = "parquet", text_ends: bool = False) -> DataFrame:
    """IP range table (ip_from, ip_to inclusive, country_short, country_long, region, city).
    With ``text_ends`` the ends are text: 128-bit numbers in digits (the IPv6 editions, with
    IPv4 at its mapped place) or addresses; else IPv4 numbers. A missing range file fails the job at
    once; ``operators.ranges.bad_ranges`` lists rows whose ends cannot be used."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"IP range data not found: {path}")
    schema = T.StructType([T.StructField(f.name, T.StringType()) for f in IP_RANGES_SCHEMA.fields]) if text_ends else IP_RANGES_SCHEMA
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", "false").csv(path)
    return reader.format(fmt).load(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured product pages (product_id, url, html[, status_code])."""
    return spark.read.parquet(path)


# Extended-JSON object id: {"$oid": "<24 hex>"}
_OID = r'^\s*\{\s*"\$oid"\s*:\s*"([0-9A-Fa-f]{24})"\s*\}\s*$'


# A date with a time zone: "...T00:00:00Z", "...+02:00", "... UTC"
_ZONED = r"[0-9]\s*(Z|UTC|GMT|[+-][0-9]{1,2}(:?[0-9]{2})?)$"


def _instant(micros: Column) -> Column:
    """Microseconds since the epoch as a UTC timestamp without zone."""
    days = F.floor(micros / F.lit(86_400_000_000)).cast("int")
    rest = F.pmod(micros, F.lit(86_400_000_000).cast("long"))
    interval = F.make_dt_interval(days, F.lit(0), F.lit(0), (rest.cast("decimal(18,0)") / F.lit(1_000_000)).cast("decimal(18,6)"))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + interval


def _epoch(text: Column, factor: Column) -> Column:
    """Microseconds of a number given as text; null beyond the years 1 to 9999."""
    n = (text.try_cast("decimal(30,6)") * factor).try_cast("decimal(38,0)")
    return F.when((n >= -62_135_596_800_000_000) & (n < 253_402_300_800_000_000), n.cast("long"))


def utc_timestamp(text: Column) -> Column:
    """The UTC timestamp (without zone) of a JSON value given as text: a date in ISO form
    (without a zone it is taken as it stands), extended JSON (``$date`` as ISO text,
    milliseconds or ``$numberLong``; ``$timestamp``) or an epoch number (from 10^11 on in
    milliseconds, from 10^14 in microseconds, below in seconds). Null for anything else."""
    date = F.get_json_object(text, "$['$date']")
    millis = F.coalesce(F.get_json_object(date, "$['$numberLong']"), date)
    plain = F.trim(F.coalesce(date, text))
    size = F.abs(plain.try_cast("double"))
    factor = (F.when(size >= 1e14, F.lit(1)).when(size >= 1e11, F.lit(1000)).otherwise(F.lit(1_000_000))).cast("decimal(7,0)")
    number = F.when(date.isNotNull(), _epoch(millis, F.lit(1000).cast("decimal(7,0)"))).otherwise(_epoch(plain, factor))
    number = F.coalesce(number, _epoch(F.get_json_object(text, "$['$timestamp'].t"), F.lit(1_000_000).cast("decimal(7,0)")))
    iso = F.when(plain.rlike(_ZONED) & plain.contains(":"), _instant(F.unix_micros(plain.try_cast("timestamp")))).otherwise(
        plain.try_cast("timestamp_ntz"))
    return F.when(number.isNotNull(), _instant(number)).when(size.isNull(), iso)


def _typed(text: Column, kind: T.DataType) -> Column:
    """A JSON value given as text in its declared type; null if it does not convert."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.TimestampNTZType):
        return utc_timestamp(text)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(text, kind)
    return text.try_cast(kind)


def _json_lines(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """The lines of a JSON export, all fields as text, so ``_malformed`` is filled only where
    the line itself is no JSON document."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in [*fields, "_malformed"]])
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_malformed").json(path))


def read_json_events(spark: SparkSession, path: str, schema: T.StructType = RAW_JSON_SCHEMA,
                     id_col: str = "_id") -> DataFrame:
    """Raw events exported as JSON lines (one document per line, extended JSON). Malformed
    lines are left out; ``read_bad_json`` gives them, and no others.

    Every field is read as text: any scalar as it stands, any nested value as its JSON
    text, so mixed-type fields never fail the read. A field declared otherwise is then
    converted (``utc_timestamp`` for ts); a value that does not convert is null and its
    event stays. The object id ``{"$oid": "..."}`` becomes its 24-hex string (fixed width,
    so text order is the id order)."""
    df = _json_lines(spark, path, schema.names)
    # always true, but names a second column: the reader refuses queries (a count, say) that
    # need the malformed text alone
    read = F.col(id_col).isNull() | (F.length(id_col) >= 0)
    df = df.where(F.col("_malformed").isNull() & read)
    df = df.select(*[_typed(F.col(f"`{f.name}`"), T.StringType() if f.name == id_col else f.dataType).alias(f.name) for f in schema.fields])
    oid = F.nullif(F.regexp_extract(F.col(id_col), _OID, 1), F.lit(""))
    return df.withColumn(id_col, F.coalesce(F.lower(oid), F.col(id_col)))


def read_json_documents(spark: SparkSession, path: str, id_col: str = "_id") -> DataFrame:
    """Every field of every document of a JSON-lines export: (``id_col``, doc), the document as one
    variant, whatever its fields and their types. Malformed lines are left out (``read_bad_json``)."""
    lines = spark.read.text(path).select(F.try_parse_json("value").alias("doc")).where(F.col("doc").isNotNull())
    oid = F.lower(F.try_variant_get("doc", f"$.{id_col}['$oid']", "string"))
    return lines.select(F.coalesce(oid, F.try_variant_get("doc", f"$.{id_col}", "string")).alias(id_col), "doc")


def read_bad_json(spark: SparkSession, path: str) -> DataFrame:
    """The malformed lines of a JSON-lines export (source_file, line), to be quarantined and
    counted: those that ``read_json_events`` leaves out. Blank lines are no documents."""
    df = _json_lines(spark, path, ["_id"]).withColumn("source_file", F.col("_metadata.file_path"))
    read = F.col("_id").isNull() | (F.length("_id") >= 0)
    return df.where(F.col("_malformed").isNotNull() & read).select("source_file", F.col("_malformed").alias("line"))


def read_source(spark: SparkSession, fmt: str, path: str | None = None, schema: T.StructType | None = None,
                **options: str) -> DataFrame:
    """Any Spark data source (e.g. a document-store connector with
    ``fmt="mongodb"`` and its connection options, ``jdbc``, ``json``, ``orc``), giving the
    same DataFrame the rest of the pipeline expects. A format whose connector is not on
    the classpath fails with a clear message."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path) if path is not None else reader.load()
    except Exception as exc:  # noqa: BLE001
        if "DATA_SOURCE_NOT_FOUND" in str(exc) or "Failed to find data source" in str(exc):
            raise RuntimeError(f"data source '{fmt}' is not available: add its connector to the "
                               "session (spark.jars.packages) and retry") from exc
        raise
