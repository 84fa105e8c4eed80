"""Column catalogue and the one-pass quality profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.config import ProfileConfig

# Output names of the default clickstream profile (FIXED VALUES of the profile report).
DEFAULT_NAMES = {
    "distinct:device_id": "distinct_devices",
    "distinct:store_id": "distinct_stores",
    "distinct:api_version": "distinct_api_versions",
    "zero:price": "zero_or_null_price_count",
}


def blank(c: str):
    return F.col(c).isNull() | (F.col(c) == "")


def count_if(cond):
    return F.count(F.when(cond, F.lit(1)))


def percent(num, den, digits: int = 2):
    # Decimal arithmetic: exact half-up rounding, null (not an error) on an empty table.
    return F.round(F.try_divide(num.cast("decimal(38,0)") * F.lit(100), den.cast("decimal(38,0)")), digits).cast("double")


def profile(df: DataFrame, cfg: ProfileConfig = ProfileConfig(), names: dict[str, str] | None = None) -> DataFrame:
    """One row, one pass: total rows; key distinct count, uniqueness verdict and null
    keys; blank-or-null counts (and percentages); distinct counts; null/blank/'0' counts.
    ``approximate`` swaps exact distinct counts (one Expand branch per column) for
    HyperLogLog sketches."""
    names = {**DEFAULT_NAMES, **(names or {})}
    if cfg.approximate:
        def distinct(c):
            return F.approx_count_distinct(c, cfg.rsd)
    else:
        distinct = F.count_distinct
    total = F.count(F.lit(1))
    dkey = distinct(cfg.key)
    aggs = [total.alias("total_rows"), dkey.alias("distinct_id_count"),
            F.when(total == dkey, F.lit("Passed")).otherwise(F.lit("Failed - Duplicated")).alias("is_id_unique"),
            count_if(F.col(cfg.key).isNull()).alias("null_key_count")]
    for c in cfg.blank_cols:
        aggs.append(count_if(blank(c)).alias(f"null_{c}"))
        if c in cfg.pct_cols:
            aggs.append(percent(count_if(blank(c)), total).alias(f"null_pct_{c}"))
    for c in cfg.distinct_cols:
        aggs.append(distinct(c).alias(names.get(f"distinct:{c}", f"distinct_{c}")))
    for c in cfg.zero_cols:
        aggs.append(count_if(blank(c) | (F.col(c) == "0")).alias(names.get(f"zero:{c}", f"zero_or_null_{c}_count")))
    return df.agg(*aggs)


def key_uniqueness(df: DataFrame, key: str = "_id") -> DataFrame:
    total = F.count(F.lit(1))
    d = F.count_distinct(key)
    return df.agg(total.alias("total_rows"), d.alias("distinct_id_count"),
                  F.when(total == d, F.lit("Passed")).otherwise(F.lit("Failed - Duplicated")).alias("is_id_unique"),
                  count_if(F.col(key).isNull()).alias("null_key_count"))


def blank_rates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    total = F.count(F.lit(1))
    aggs = [total.alias("total_rows")]
    for c in cols:
        aggs += [count_if(blank(c)).alias(f"null_{c}"), percent(count_if(blank(c)), total).alias(f"null_pct_{c}")]
    return df.agg(*aggs)


def distinct_counts(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[distinct(c).alias(f"distinct_{c}") for c in cols])


def zero_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[count_if(blank(c) | (F.col(c) == "0")).alias(f"zero_or_null_{c}_count") for c in cols])


def catalog_columns(tables: dict, schemas: dict | None = None, spark=None, counts: bool = True) -> DataFrame:
    """(table_name, column_name, data_type, is_nullable, ordinal_position, non_null_count)
    ordered by table and position. ``tables`` maps names to DataFrames or to catalog
    table names (read with ``spark.table``). Names/types come from each table's declared
    schema (``schemas``) or its schema; the non-null counts are one aggregate per table.
    Without ``counts`` the listing is metadata alone (no such column): no row is read."""
    from functools import reduce
    schemas = schemas or {}
    parts = []
    for tname, df in tables.items():
        if isinstance(df, str):
            df = spark.table(df)
        fields = (schemas.get(tname) or df.schema).fields
        if not counts:
            parts += [(tname, f.name, f.dataType.simpleString().upper(), "YES" if f.nullable else "NO", i + 1) for i, f in enumerate(fields)]
            session = df.sparkSession
            continue
        wide = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
        rows = F.explode(F.array(*[
            F.struct(F.lit(tname).alias("table_name"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString().upper()).alias("data_type"),
                     F.lit("YES" if f.nullable else "NO").alias("is_nullable"),
                     F.lit(i + 1).alias("ordinal_position"), F.col(f"c{i}").alias("non_null_count"))
            for i, f in enumerate(fields)]))
        parts.append(wide.select(rows.alias("r")).select("r.*"))
    if not counts:
        kind = "table_name string, column_name string, data_type string, is_nullable string, ordinal_position int"
        return session.createDataFrame(sorted(parts, key=lambda r: (r[0], r[4])), kind)
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.orderBy("table_name", "ordinal_position")
