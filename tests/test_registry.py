"""Every registered query against its DuckDB oracle on the smallest scale, and the
expected fixture values at sf0.01."""

import os

import pytest

import __spark_entry__ as entry
from clickflow.plans import registry
from conftest import SF_MID, SF_SMALL

duckdb = pytest.importorskip("duckdb")
TABLES = "region nation customer supplier part orders lineitem events pages".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _canon(cols, rs):
    import math
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 6))
        if hasattr(v, "isoformat"):
            return v.isoformat()
        return "∅" if v is None else str(v)
    return sorted("|".join(norm(r[i]) for i in order) for r in rs)


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _canon(sdf.columns, [tuple(r) for r in sdf.collect()]) == _canon(dcols, res.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["product_id", "url", "event_group", "_id"] and df.count() > 0


@pytest.mark.skipif(not os.path.exists(SF_MID), reason="sf0.01 not present")
def test_expected_fixture_values(spark):
    q = entry.queries()
    assert q["candidates"](spark, SF_MID).count() == 3055
    c = q["count_ips"](spark, SF_MID).first()
    assert (c["distinct_ips"], c["distinct_ips_non_null"]) == (4091, 4090)
    r = q["ip_quality"](spark, SF_MID).first()
    assert (r["dq_valid"], r["dq_missing_location_info"], r["dq_invalid_ip"], r["dq_missing_ip"]) == (3187, 900, 2, 2)
    from pyspark.sql import functions as F
    v = q["validate_product"](spark, SF_MID)
    shapes = {(r["shape"], r["reason"]): r["n"] for r in
              v.groupBy((F.col("page_id") % 4).alias("shape"), "reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert shapes == {(0, "valid"): 63, (1, "valid"): 63, (2, "valid"): 62, (3, "missing_name"): 62}
    o = q["outcome_counts"](spark, SF_MID).first()
    assert (o["success"], o["err_404"], o["err_403"], o["err_other"], o["err_429"], o["err_5xx"], o["err_network"]) == \
        (123, 44, 21, 19, 18, 17, 8)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_plan_has_no_pairs_and_no_python(spark, name):
    from conftest import plan_text
    text = plan_text(entry.queries()[name](spark, SF_SMALL))
    for bad in ("NestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text, f"{name}: {bad}"


@pytest.mark.parametrize("view", ["raw_data", "ip_ranges", "product_pages", "attempts"])
def test_fixture_views_equal_their_sql(spark, con, view):
    from clickflow.sources import fixtures as fx
    sdf = getattr(fx, view)(spark, SF_SMALL)
    res = con.execute(fx.FIXTURE_SQL[view])
    dcols = [d[0] for d in res.description]
    assert sdf.columns == dcols
    assert _canon(sdf.columns, [tuple(r) for r in sdf.collect()]) == _canon(dcols, res.fetchall())
