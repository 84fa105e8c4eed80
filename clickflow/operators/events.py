"""Event filtering and field resolution (event groups, product id, URL, watermark)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.config import GROUP1_EVENTS, GROUP2_EVENTS
from clickflow.functions.text import first_truthy, truthy_text


def tag_event_group(df: DataFrame, group1: Sequence[str] = GROUP1_EVENTS,
                    group2: Sequence[str] = GROUP2_EVENTS, event_col: str = "collection",
                    out: str = "event_group") -> DataFrame:
    """Keep rows of either group and tag them 1 (direct product events) or 2
    (recommendation click). The isin predicate is pushed to the Parquet scan."""
    g1, g2 = list(group1), list(group2)
    ev = F.col(event_col)
    return (df.where(ev.isin(g1 + g2))
            .withColumn(out, F.when(ev.isin(g1), F.lit(1)).otherwise(F.lit(2))))


def resolved_product_id(group_col: str = "event_group", types: dict | None = None) -> "F.Column":
    """Group 1: first truthy of product_id, viewing_product_id; group 2: viewing_product_id
    when truthy. The result is text (ids are compared as strings everywhere)."""
    types = types or {}
    return (F.when(F.col(group_col) == 1, first_truthy("product_id", "viewing_product_id", types=types))
            .otherwise(truthy_text("viewing_product_id", types.get("viewing_product_id"))))


def resolve_product_id(df: DataFrame, group_col: str = "event_group", out: str = "resolved_id") -> DataFrame:
    """Add the resolved product id (null when no truthy id exists)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumn(out, resolved_product_id(group_col, types).cast("string"))


def resolve_url(df: DataFrame, markers: Sequence[str] = (), group_col: str = "event_group",
                out: str = "url", keep_invalid: bool = False) -> DataFrame:
    """Group 1 takes current_url, group 2 referrer_url. Rows whose URL is null/blank or
    holds one of the test-site markers (case-sensitive substrings) are dropped, or with
    ``keep_invalid`` keep a null URL."""
    url = F.when(F.col(group_col) == 1, F.col("current_url")).otherwise(F.col("referrer_url")).cast("string")
    df = df.withColumn(out, url)
    cond = F.col(out).isNotNull() & (F.col(out) != "")
    for m in markers:
        cond = cond & ~F.col(out).contains(m)
    return df.withColumn(out, F.when(cond, F.col(out))) if keep_invalid else df.where(cond)


def slice_after(df: DataFrame, key: str, last_id) -> DataFrame:
    """Rows with ``key`` strictly above the saved watermark; all rows when there is none.
    The comparison is a literal, so Parquet row-group statistics can skip whole groups."""
    if last_id is None:
        return df
    return df.where(F.col(key) > F.lit(last_id))
