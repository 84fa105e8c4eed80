"""Export and load plans over several tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.config import EXPORT_CHUNK_SIZE
from clickflow.operators import export as ex


def export_tables(spark: SparkSession, tables: dict, root: str, key: str = "_id",
                  size: int = EXPORT_CHUNK_SIZE) -> DataFrame:
    """Incremental export of each table (parts + state). ``tables`` maps a name to a DataFrame
    (ordered by ``key``, which grows with arrival) or to ``(DataFrame, its key)``; another key
    than ``key`` (product_id, ip) says nothing about arrival, so such a table is compared with
    its exported keys. One table's failure does not stop the others; it is raised at the end.
    Returns (table_name, part_number, rows, first_id, last_id) of the parts written now."""
    out, failed = [], []
    for name, spec in tables.items():
        df, k = spec if isinstance(spec, tuple) else (spec, key)
        try:
            m = ex.incremental_export(spark, df, root, name, k, size, arrival_ordered=k == key)
            out.append(m.select(F.lit(name).alias("table_name"), "*"))
        except Exception as exc:  # noqa: BLE001 - continue with the next table
            failed.append(f"{name}: {type(exc).__name__}: {exc}")
    if failed:
        raise RuntimeError(f"{len(failed)} of {len(tables)} exports failed: " + "; ".join(failed))
    if not out:
        return spark.createDataFrame([], "table_name string, part_number int, rows bigint, first_id string, last_id string")
    return reduce(lambda a, b: a.unionByName(b), out)
