"""Normalisation and ordered data-quality rules (first failing rule wins)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.config import INVALID_ADDRESS_TEXT, LOCATION_MISSING_MARKERS, UNKNOWN_NAME
from clickflow.functions.text import strip_ws

PRODUCT_FIELDS = ("product_id", "product_name", "url")
LOCATION_FIELDS = ("country_short", "country_long", "region", "city")


def _norm(c: str) -> Column:
    # null -> '', cast to string, strip surrounding whitespace
    return strip_ws(F.coalesce(F.col(c).cast("string"), F.lit("")))


def normalize_product(df: DataFrame, fields: Sequence[str] = PRODUCT_FIELDS) -> DataFrame:
    return df.select(*[_norm(c).alias(c) if c in fields else F.col(c) for c in df.columns])


def product_reason() -> Column:
    return (F.when(F.col("product_id") == "", "missing_id")
            .when((F.col("product_name") == "") | (F.lower("product_name") == UNKNOWN_NAME.lower()), "missing_name")
            .when(F.col("url") == "", "missing_url")
            .otherwise("valid"))


def validate_product(df: DataFrame) -> DataFrame:
    """Adds ``reason`` and ``is_valid`` over normalised rows."""
    return df.withColumn("reason", product_reason()).withColumn("is_valid", F.col("reason") == "valid")


def normalize_location(df: DataFrame, fields: Sequence[str] = ("ip",) + LOCATION_FIELDS) -> DataFrame:
    return df.select(*[_norm(c).alias(c) if c in fields else F.col(c) for c in df.columns])


def location_reason() -> Column:
    markers = list(LOCATION_MISSING_MARKERS)
    missing = None
    for c in LOCATION_FIELDS:
        t = F.col(c).isin(markers)
        missing = t if missing is None else (missing | t)
    return (F.when(F.col("ip") == "", "missing_ip")
            .when(missing, "missing_location_info")
            .when(F.upper("country_long") == INVALID_ADDRESS_TEXT, "invalid_ip")
            .otherwise("valid"))


def validate_location(df: DataFrame) -> DataFrame:
    return df.withColumn("reason", location_reason()).withColumn("is_valid", F.col("reason") == "valid")


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows without the rule columns, rejected rows with their reason)."""
    clean = df.where(F.col("is_valid")).drop("is_valid", "reason")
    rejects = df.where(~F.col("is_valid")).drop("is_valid")
    return clean, rejects
