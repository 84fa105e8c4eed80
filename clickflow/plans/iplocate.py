"""IP-location plan: distinct addresses -> range lookup -> normalise -> validate ->
full refresh of ip_locations, with the reason counters observed on that write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickflow.operators import geo
from clickflow.operators import quality as dq
from clickflow.operators import sinks
from clickflow.operators.ranges import bad_ranges


def validated_locations(raw: DataFrame, ranges: DataFrame, ip_col: str = "ip") -> DataFrame:
    return dq.validate_location(dq.normalize_location(geo.locate_ips(geo.unique_ips(raw, ip_col), ranges)))


def run_ip_locations(spark: SparkSession, raw: DataFrame, ranges: DataFrame, out_path: str,
                     rejects_path: str | None = None) -> dict:
    """Rebuild ip_locations (and, with ``rejects_path``, the quarantined rows); returns
    total and per-reason counts (they sum to total). Ranges may nest or cross (the narrowest
    wins); ends that are missing, no addresses, outside the address space or the wrong way round
    fail the job before anything is written: the lookup would miss addresses."""
    broken = bad_ranges(ranges).limit(1).collect()
    if broken:
        raise ValueError(f"IP ranges with bad ends, for example {broken[0].asDict()}")
    validated = validated_locations(raw, ranges)
    if rejects_path is not None:
        validated = validated.persist()          # shared by the two sinks
    counters = sinks.refresh_locations(validated, out_path)
    if rejects_path is not None:
        rejects = validated.where(~validated["is_valid"]).drop("is_valid")
        rejects.write.mode("overwrite").parquet(rejects_path)
        validated.unpersist()
    total = counters.get("total", 0)
    counters["valid_rate"] = round(100.0 * counters.get("dq_valid", 0) / total, 1) if total else None
    return counters
