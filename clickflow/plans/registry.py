"""Query registry: name -> (Spark query over an sf folder, DuckDB oracle SQL or None).

Each Spark query reads the driver's tables (or views Spark derives from them) whole;
the oracle SQL computes the same result on the same Parquet files in DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, doc: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, doc or (fn.__doc__ or "").strip())
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules fills REGISTRY; queries whose oracle embeds other queries'
    # SQL are registered after those exist.
    from clickflow.plans import q_capture, q_geo, q_export, q_warehouse, q_profile  # noqa: F401
    if "export_all_tables" not in REGISTRY:
        REGISTRY["export_all_tables"] = Query("export_all_tables", q_warehouse.q_export_all_tables,
                                              q_warehouse._export_all_sql(),
                                              (q_warehouse.q_export_all_tables.__doc__ or "").strip())
    if "catalog_all_tables" not in REGISTRY:
        REGISTRY["catalog_all_tables"] = Query("catalog_all_tables", q_profile.q_catalog_all_tables,
                                               q_profile._catalog_all_sql(),
                                               (q_profile.q_catalog_all_tables.__doc__ or "").strip())
    if "load_all_tables" not in REGISTRY:
        REGISTRY["load_all_tables"] = Query("load_all_tables", q_warehouse.q_load_all_tables,
                                            q_warehouse._load_all_sql(),
                                            (q_warehouse.q_load_all_tables.__doc__ or "").strip())


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {k: q.fn for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: q.sql for k, q in REGISTRY.items() if q.sql is not None}
