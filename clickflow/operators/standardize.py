"""Schema-driven type standardisation for export.

The original samples 100 values per column to guess whether it holds lists/dicts; here
the schema says it, so every row is treated alike and no value is guessed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.config import FORCE_STRING_COLUMNS

_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
# Keep null fields inside JSON objects ({"a": null}), as a JSON library would.
JSON_OPTIONS = {"ignoreNullFields": "false"}


def is_nested_type(dt: T.DataType) -> bool:
    return isinstance(dt, _NESTED)


def json_text(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.VariantType):
        return F.try_variant_get(c, "$", "string")  # plain text of scalars, JSON of arrays and objects
    return F.to_json(c, JSON_OPTIONS)


def standardize(df: DataFrame, force_string: Sequence[str] = FORCE_STRING_COLUMNS) -> DataFrame:
    """(a) forced columns: null -> '' and cast to string; (b) list/map/struct/variant
    columns -> JSON text (null stays null, non-ASCII kept); (c) string columns keep their
    nulls; (d) numeric/bool/date columns are untouched."""
    forced = set(force_string)
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in forced:
            out.append(F.coalesce(c.cast("string"), F.lit("")).alias(f.name))
        elif is_nested_type(f.dataType):
            out.append(json_text(c, f.dataType).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def nested_to_json(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Only the nested columns (or ``cols``) rewritten as JSON text."""
    names = set(cols) if cols is not None else {f.name for f in df.schema.fields if is_nested_type(f.dataType)}
    return df.select(*[json_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) if f.name in names
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def looks_nested(c: Column) -> Column:
    """A JSON text value holding an array or an object. The first-character test comes
    first, so the parser only runs on values that can be arrays/objects."""
    opens = F.substring(F.ltrim(c), 1, 1).isin("[", "{")
    return F.coalesce(opens & F.try_parse_json(c).isNotNull(), F.lit(False))


def detect_nested(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per string column: non-null values, values holding a JSON array/object, verdict.
    All rows are inspected in one pass (no sampling); the wide one-row result is then
    unpivoted to one row per column."""
    names = list(cols) if cols is not None else [f.name for f in df.schema.fields
                                                  if isinstance(f.dataType, T.StringType)]
    aggs = []
    for i, n in enumerate(names):
        c = F.col(f"`{n}`")
        aggs.append(F.count(c).alias(f"nn_{i}"))
        aggs.append(F.count(F.when(looks_nested(c), F.lit(1))).alias(f"nj_{i}"))
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.col(f"nn_{i}").alias("non_null"),
                 F.col(f"nj_{i}").alias("nested_values"))
        for i, n in enumerate(names)]))
    return (wide.select(rows.alias("r")).select("r.*")
            .withColumn("is_nested", F.col("nested_values") > 0))


def sample_non_null(df: DataFrame, col: str, n: int = 100) -> DataFrame:
    """``n`` non-null values of a column, the same on every run (those with the least hashes; the
    limit is the feature). The top-n is taken per task first."""
    value = F.col(f"`{col}`")
    order = [F.xxhash64(json_text(value, df.schema[col].dataType) if is_nested_type(df.schema[col].dataType) else value), F.col("_t")]
    text = json_text(value, df.schema[col].dataType) if is_nested_type(df.schema[col].dataType) else value.cast("string")
    return df.where(value.isNotNull()).select(value, text.alias("_t")).orderBy(*order).limit(n).select(col)


def sample_columns(df: DataFrame, cols: Sequence[str] | None = None, n: int = 100, key: str | None = None) -> DataFrame:
    """(column_name, place, value): ``n`` non-null values of every column as text (nested ones as JSON), in
    one pass over the rows. A bottom-k sample by the MD5 of key and column (or of the value, if no
    ``key`` is given): the least hashes of any part hold those of the whole, so each task keeps its
    own ``n`` per column and only these are shuffled; ties go by the value, so every run gives
    the same rows. Null keys hash as blank ones."""
    names = list(cols) if cols is not None else list(df.columns)
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def text(c: str) -> Column:
        return json_text(F.col(f"`{c}`"), kinds[c]) if is_nested_type(kinds[c]) else F.col(f"`{c}`").cast("string")

    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), text(c).alias("value")) for c in names])
    by = F.col("_key").cast("string") if key else F.col("c.value")
    long = df.select(*([F.col(f"`{key}`").alias("_key")] if key else []), F.explode(cells).alias("c")).where("c.value IS NOT NULL")
    long = long.select("c.column_name", "c.value", F.md5(F.concat(F.coalesce(by, F.lit("")), F.lit("|"), F.col("c.column_name"))).alias("_h"))
    w = Window.partitionBy("column_name").orderBy("_h", "value")
    return long.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n).select("column_name", "place", "value")
