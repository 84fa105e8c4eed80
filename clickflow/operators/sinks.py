"""Sinks: result log, clean products, ip_locations, finished ids.

Counters can ride on a write through ``Observation`` (one pass computes the sink and
the counts)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clickflow.config import FINAL_STATUSES, STATUSES

RESULT_LOG_COLUMNS = ("product_id", "product_name", "url", "status", "http_code", "error_msg")
RESULT_LOG_SCHEMA = ("product_id string, product_name string, url string, status string, "
                     "http_code int, error_msg string")
PRODUCT_COLUMNS = ("product_id", "product_name", "url")
LOCATION_COLUMNS = ("ip", "country_short", "country_long", "region", "city")


def _status_counters(status_col: str = "status"):
    st = F.col(status_col)
    known = [s for s in STATUSES if s != "err_other"]
    aggs = [F.count(F.lit(1)).alias("processed")]
    aggs += [F.count(F.when(st == s, F.lit(1))).alias(s) for s in known]
    aggs.append(F.count(F.when(~st.isin(known) | st.isNull(), F.lit(1))).alias("err_other"))
    return aggs


def write_result_log(df: DataFrame, path: str, fmt: str = "csv", observe: bool = True, mode: str = "append") -> dict | None:
    """Append every outcome with the six log columns (absent fields null/empty). CSV gets
    a header in every part file. ``mode="overwrite"`` replaces the folder, for a round that is run
    again. Returns the outcome counters measured on the write."""
    out = df.select(*RESULT_LOG_COLUMNS)
    obs = None
    if observe:
        obs = Observation("result_log")
        out = out.observe(obs, *_status_counters())
    w = out.write.mode(mode)
    if fmt == "csv":
        # keep values as they are: Spark's CSV writer trims surrounding spaces by default
        (w.option("header", "true").option("encoding", "UTF-8")
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
         .csv(path))
    else:
        w.format(fmt).save(path)
    return obs.get if obs is not None else None


def append_products(df: DataFrame, path: str, key: str | None = "product_id") -> None:
    """Append clean products. With ``key``, only products whose key is not stored yet
    are appended (insert-only), so replaying a round after a crash adds nothing twice."""
    from clickflow.operators.warehouse import merge_insert_only
    from clickflow.sources.tables import _exists
    rows = df.select(*PRODUCT_COLUMNS)
    if key is not None and _exists(df.sparkSession, path):
        rows = merge_insert_only(df.sparkSession.read.parquet(path), rows, key)
    rows.write.mode("append").parquet(path)


def refresh_locations(validated: DataFrame, path: str) -> dict:
    """Full refresh of ip_locations with the valid rows; the reason counters are observed
    on the same pass (no second evaluation of the lookup)."""
    obs = Observation("ip_locations")
    r = F.col("reason")
    counted = validated.observe(
        obs, F.count(F.lit(1)).alias("total"),
        *[F.count(F.when(r == x, F.lit(1))).alias(f"dq_{x}")
          for x in ("missing_ip", "missing_location_info", "invalid_ip", "valid")])
    counted.where(F.col("is_valid")).select(*LOCATION_COLUMNS).write.mode("overwrite").parquet(path)
    return obs.get


def append_finished(results: DataFrame, path: str, final: Sequence[str] = FINAL_STATUSES, mode: str = "append") -> None:
    """Append finished ids as text, one id per line, one folder per status
    (``status=success``, ``status=err_404``). Call after the batch's other sinks commit.
    ``mode="overwrite"`` replaces the folder, for a round that is run again."""
    (results.where(F.col("status").isin(list(final)))
     .select(F.col("product_id").cast("string").alias("value"), "status")
     .where(F.col("value").isNotNull() & (F.col("value") != ""))
     .write.mode(mode).option("partitionOverwriteMode", "static").partitionBy("status").text(path))


def finished_paths(root: str, final: Sequence[str] = FINAL_STATUSES) -> list[str]:
    return [f"{root.rstrip('/')}/status={s}" for s in final]


def append_rejects(rejects: DataFrame, path: str, mode: str = "append") -> None:
    """Quarantine: rejected rows with their first failing rule, appended as Parquet.
    ``mode="overwrite"`` replaces the folder, for a round that is run again."""
    rejects.write.mode(mode).parquet(path)
