"""Profile of a table that grows by parts, from mergeable sketches stored per part.

Each part file is read once: its row, blank and null counts and the HyperLogLog sketches of its
distinct columns go to a small table beside the parts. A profile adds the counts and merges the sketches of
the files that are there now, so after a new part only that part is read, and a part that was
replaced or deleted no longer counts. Counts are exact; distinct counts have the relative error of
the sketches (``ERROR``, one standard deviation)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.config import ProfileConfig
from clickflow.operators.profile import DEFAULT_NAMES, blank, count_if, percent
from clickflow.sources import fs

#: Size of a sketch (2^LG_K registers) and its relative standard error.
LG_K = 14
ERROR = 1.04 / 2 ** (LG_K / 2)


def _store(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/_profile/{table}"


def _files(spark: SparkSession, root: str, table: str) -> DataFrame:
    """(path, length) of the part files, from the listing alone."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
            .load(f"{root.rstrip('/')}/{table}").select("path", "length"))


def _distinct_columns(cfg: ProfileConfig) -> list[str]:
    return list(dict.fromkeys([cfg.key, *cfg.distinct_cols]))


def part_sketches(df: DataFrame, cfg: ProfileConfig = ProfileConfig(), by: str = "path") -> DataFrame:
    """One row per value of ``by``: counts and sketches of its rows."""
    aggs = [F.count(F.lit(1)).alias("rows"), count_if(F.col(cfg.key).isNull()).alias("null_key")]
    aggs += [count_if(blank(c)).alias(f"blank_{c}") for c in cfg.blank_cols]
    aggs += [count_if(blank(c) | (F.col(c) == "0")).alias(f"zero_{c}") for c in cfg.zero_cols]
    aggs += [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LG_K)).alias(f"hll_{c}") for c in _distinct_columns(cfg)]
    return df.groupBy(by).agg(*aggs)


def update_sketches(spark: SparkSession, root: str, table: str, cfg: ProfileConfig = ProfileConfig()) -> int:
    """Read the part files below ``root/<table>`` that have no sketches yet and store theirs.
    Returns how many files that were (their names are all that comes to the driver)."""
    store, files = _store(root, table), _files(spark, root, table)
    if fs.exists(spark, store):
        files = files.join(spark.read.parquet(store).select("path", "length"), ["path", "length"], "left_anti")
    new = {r["path"]: r["length"] for r in files.collect()}
    if new:
        rows = spark.read.option("mergeSchema", "true").parquet(*new).withColumn("_src", F.col("_metadata.file_path"))
        made = part_sketches(rows, cfg, "_src")
        # the listing's spelling of the paths is the key
        made.join(files, _bare(F.col("_src")) == _bare(F.col("path"))).drop("_src").write.mode("append").parquet(store)
    return len(new)


def _bare(path):
    """A path without its scheme: listings and scans may spell local ones with one or three slashes."""
    return F.regexp_replace(path, "^[a-zA-Z]+:/*", "/")


def stored_profile(spark: SparkSession, root: str, table: str, cfg: ProfileConfig = ProfileConfig(),
                   names: dict[str, str] | None = None) -> DataFrame:
    """The columns of ``profile`` from the stored sketches of the files that are there now, after
    reading the new ones. The uniqueness verdict fails where fewer distinct keys are estimated than rows
    less three standard errors."""
    update_sketches(spark, root, table, cfg)
    names = {**DEFAULT_NAMES, **(names or {})}
    # a file sketched twice (two updates at once) counts once
    held = spark.read.parquet(_store(root, table)).dropDuplicates(["path", "length"])
    held = held.join(_files(spark, root, table), ["path", "length"], "left_semi")

    def distinct(c: str):
        return F.hll_sketch_estimate(F.hll_union_agg(f"hll_{c}"))

    total, keys = F.sum("rows"), distinct(cfg.key)
    aggs = [F.coalesce(total, F.lit(0)).alias("total_rows"), F.coalesce(keys, F.lit(0)).alias("distinct_id_count"),
            F.when(keys >= total * (1 - 3 * ERROR), F.lit("Passed")).otherwise(F.lit("Failed - Duplicated")).alias("is_id_unique"),
            F.sum("null_key").alias("null_key_count")]
    for c in cfg.blank_cols:
        aggs.append(F.sum(f"blank_{c}").alias(f"null_{c}"))
        if c in cfg.pct_cols:
            aggs.append(percent(F.sum(f"blank_{c}"), total).alias(f"null_pct_{c}"))
    aggs += [distinct(c).alias(names.get(f"distinct:{c}", f"distinct_{c}")) for c in cfg.distinct_cols]
    aggs += [F.sum(f"zero_{c}").alias(names.get(f"zero:{c}", f"zero_or_null_{c}_count")) for c in cfg.zero_cols]
    return held.agg(*aggs)
