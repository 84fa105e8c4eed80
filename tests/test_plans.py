"""End-to-end plans and sinks: capture rounds, IP refresh, multi-table export, pushdown."""

from pyspark.sql import functions as F

from clickflow.plans.capture import run_capture
from clickflow.plans.iplocate import run_ip_locations
from clickflow.plans.multi_table import export_tables
from clickflow.session import work_path
from clickflow.sources import fixtures as fx
from clickflow.sources.tables import read_events, read_finished_ids
from conftest import SF_SMALL, plan_text


def test_run_capture_rounds(spark):
    root = work_path(spark, "t-capture")
    raw = fx.raw_data(spark, SF_SMALL)
    att = fx.attempts(spark, SF_SMALL)
    pages = fx.product_pages(spark, SF_SMALL)
    # make every candidate have an attempt log: pages keyed by the candidates' ids
    reports = run_capture(spark, raw, att, pages, root, ["stage.shop", "test.shop"], rounds=3)
    assert reports and reports[0]["processed"] >= reports[0]["success"]
    log = spark.read.option("header", "true").csv(f"{root}/result_log")
    assert set(log.columns) == {"product_id", "product_name", "url", "status", "http_code", "error_msg", "run", "round"}
    finished = read_finished_ids(spark, f"{root}/finished/status=success", f"{root}/finished/status=err_404")
    # finished ids are unique and never offered again in a later round
    assert finished.count() == finished.distinct().count()
    # one log row per item and round; without a round column there is one round
    assert len(reports) == 1 and log.count() == sum(r["processed"] for r in reports)
    assert log.select("product_id").distinct().count() == log.count()


def test_missing_finished_files_are_empty(spark):
    assert read_finished_ids(spark, "/nonexistent/a", "/nonexistent/b").count() == 0


def test_run_ip_locations(spark):
    out = work_path(spark, "t-ip")
    c = run_ip_locations(spark, fx.raw_data(spark, SF_SMALL), fx.ip_ranges(spark, SF_SMALL), out)
    assert c["total"] == c["dq_valid"] + c["dq_missing_ip"] + c["dq_missing_location_info"] + c["dq_invalid_ip"]
    assert spark.read.parquet(out).count() == c["dq_valid"]
    # full refresh: a second run replaces, it does not append
    run_ip_locations(spark, fx.raw_data(spark, SF_SMALL), fx.ip_ranges(spark, SF_SMALL), out)
    assert spark.read.parquet(out).count() == c["dq_valid"]


def test_export_tables(spark):
    root = work_path(spark, "t-tables")
    raw = fx.raw_data(spark, SF_SMALL)
    m = export_tables(spark, {"raw_data": raw, "other": raw.select("_id", "ip")}, root, size=300)
    got = {r["table_name"]: r["s"] for r in m.groupBy("table_name").agg(F.sum("rows").alias("s")).collect()}
    n = raw.count()
    assert got == {"raw_data": n, "other": n}


def test_event_scan_pushdown_and_pruning(spark):
    path = work_path(spark, "t-raw")
    fx.raw_data(spark, SF_SMALL).write.parquet(path)
    df = read_events(spark, path, ["_id", "product_id"], ["view_product_detail"])
    text = plan_text(df)
    assert "PushedFilters: [IsNotNull(collection), In(collection, [view_product_detail])]" in text \
        or "EqualTo(collection,view_product_detail)" in text
    assert "ReadSchema: struct<_id:string,collection:string,product_id:string>" in text


def test_append_products_is_idempotent(spark):
    from clickflow.operators.sinks import append_products
    path = work_path(spark, "t-products")
    df = spark.createDataFrame([("1", "A", "u1"), ("2", "B", "u2")], "product_id string, product_name string, url string")
    append_products(df, path)
    append_products(df, path)                       # replayed round
    more = spark.createDataFrame([("2", "B", "u2"), ("3", "C", "u3")], "product_id string, product_name string, url string")
    append_products(more, path)
    assert sorted(r[0] for r in spark.read.parquet(path).select("product_id").collect()) == ["1", "2", "3"]


def test_retry_invalid_keeps_unnamed_successes_open(spark):
    from clickflow.plans.capture import capture_round, finished_rows
    raw = spark.createDataFrame([("01", "view_product_detail", "A", None, "u", "r"),
                                 ("02", "view_product_detail", "B", None, "u", "r")],
                                "_id string, collection string, product_id string, viewing_product_id string, "
                                "current_url string, referrer_url string")
    att = spark.createDataFrame([("A", "u", 1, 200, None), ("B", "u", 1, 200, None)],
                                "product_id string, url string, attempt int, status_code int, error_kind string")
    pages = spark.createDataFrame([("A", '<meta property="og:title" content="Name A">'), ("B", "<p>no name</p>")],
                                  "product_id string, html string")
    rnd = capture_round(raw, att, pages, None)
    assert sorted(r[0] for r in finished_rows(rnd).select("product_id").collect()) == ["A", "B"]       # T9
    assert [r[0] for r in finished_rows(rnd, retry_invalid=True).select("product_id").collect()] == ["A"]


def test_observed_counters_equal_aggregate(spark):
    from clickflow.operators import attempts as att_ops
    from clickflow.operators.reports import outcome_counts
    from clickflow.operators.sinks import write_result_log
    log = att_ops.result_log(att_ops.resolve_attempts(fx.attempts(spark, SF_SMALL)), fx.product_pages(spark, SF_SMALL))
    observed = write_result_log(log, work_path(spark, "t-log"))
    assert observed == outcome_counts(log).first().asDict()


def test_rounds_with_per_round_attempts(spark):
    root = work_path(spark, "t-rounds")
    raw = spark.createDataFrame([("01", "view_product_detail", "A", None, "ua", "r"),
                                 ("02", "view_product_detail", "B", None, "ub", "r"),
                                 ("03", "view_product_detail", "C", None, "uc", "r")],
                                "_id string, collection string, product_id string, viewing_product_id string, "
                                "current_url string, referrer_url string")
    att = spark.createDataFrame([
        # round 1: A ok, B rate-limited three times, C 404
        (1, "A", "ua", 1, 200, None), (1, "B", "ub", 1, 429, None), (1, "B", "ub", 2, 429, None),
        (1, "B", "ub", 3, 429, None), (1, "C", "uc", 1, 404, None),
        # round 2: B is fetched again and succeeds; A and C are finished and not fetched
        (2, "B", "ub", 1, 200, None), (2, "A", "ua", 1, 500, None),
    ], "round int, product_id string, url string, attempt int, status_code int, error_kind string")
    pages = spark.createDataFrame([("A", '<meta property="og:title" content="Name A">'),
                                   ("B", '<meta property="og:title" content="Name B">')], "product_id string, html string")
    reps = run_capture(spark, raw, att, pages, root, rounds=3)
    assert [(r["round"], r["total"], r["processed"], r["success"], r["err_404"], r["err_429"]) for r in reps] == [
        (1, 3, 3, 1, 1, 1), (2, 1, 1, 1, 0, 0), (3, 0, 0, 0, 0, 0)]
    names = sorted(r[0] for r in spark.read.parquet(f"{root}/product_names").select("product_name").collect())
    assert names == ["Name A", "Name B"]



def test_ip_rejects_sink(spark):
    out, rej = work_path(spark, "t-ip2"), work_path(spark, "t-iprej")
    c = run_ip_locations(spark, fx.raw_data(spark, SF_SMALL), fx.ip_ranges(spark, SF_SMALL), out, rej)
    r = spark.read.parquet(rej)
    assert r.count() == c["total"] - c["dq_valid"] and "reason" in r.columns
