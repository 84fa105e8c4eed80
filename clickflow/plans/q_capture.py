"""Capture-side queries: candidate selection, attempt outcomes, names, quality, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.config import FIXTURE_URL_MARKERS, GROUP1_EVENTS, GROUP2_EVENTS
from clickflow.operators import attempts as att
from clickflow.operators import candidates as cand
from clickflow.operators import events as ev
from clickflow.operators import quality as dq
from clickflow.operators import reports as rep
from clickflow.plans.registry import register
from clickflow.plans.sqlparts import (CLASSIFIED, FINAL, FINISHED, FIRST_URL, G12, MESSAGES, RESOLVED,
                                      TAGGED, VALID_URLS, name_sql, strip_sql)
from clickflow.sources import fixtures as fx
from clickflow.sources.fixtures import with_fixtures

M = FIXTURE_URL_MARKERS


def _resolved_attempts(spark, d) -> DataFrame:
    return att.resolve_attempts(fx.attempts(spark, d))


def _finished(spark, d) -> DataFrame:
    return cand.finished_ids(_resolved_attempts(spark, d))


def _result_log(spark, d) -> DataFrame:
    return att.result_log(_resolved_attempts(spark, d), fx.product_pages(spark, d))


def _validated_success(spark, d) -> DataFrame:
    log = _result_log(spark, d).where(F.col("status") == "success")
    return dq.validate_product(dq.normalize_product(log.select("product_id", "product_name", "url")))


# --- SQL building blocks ---------------------------------------------------------
RESULT_LOG = f"""result_log AS (
 SELECT f.product_id, CASE WHEN f.status = 'success' THEN {name_sql('p.html')} END AS product_name,
  f.url, f.status, f.http_code, f.error_msg
 FROM final f LEFT JOIN product_pages p ON f.product_id = p.product_id)"""
NORMALIZED = f"""normalized AS (
 SELECT {strip_sql('product_id')} AS product_id, {strip_sql('product_name')} AS product_name,
  {strip_sql('url')} AS url FROM result_log WHERE status = 'success')"""
REASON = """CASE WHEN product_id = '' THEN 'missing_id'
  WHEN product_name = '' OR lower(product_name) = 'unknown name' THEN 'missing_name'
  WHEN url = '' THEN 'missing_url' ELSE 'valid' END"""
VALIDATED = f"""validated AS (SELECT *, {REASON} AS reason FROM normalized)"""
OUTCOMES = """count(*) AS processed,
 count(*) FILTER (WHERE status = 'success') AS success,
 count(*) FILTER (WHERE status = 'err_404') AS err_404,
 count(*) FILTER (WHERE status = 'err_403') AS err_403,
 count(*) FILTER (WHERE status = 'err_429') AS err_429,
 count(*) FILTER (WHERE status = 'err_5xx') AS err_5xx,
 count(*) FILTER (WHERE status = 'err_network') AS err_network,
 count(*) FILTER (WHERE status IS NULL OR status NOT IN ('success', 'err_404', 'err_403', 'err_429', 'err_5xx', 'err_network')) AS err_other"""
DQ = """count(*) FILTER (WHERE reason = 'missing_id') AS dq_missing_id,
 count(*) FILTER (WHERE reason = 'missing_name') AS dq_missing_name,
 count(*) FILTER (WHERE reason = 'missing_url') AS dq_missing_url,
 count(*) FILTER (WHERE reason = 'valid') AS dq_valid"""
ATT = ("attempts",)
ATT_PAGES = ("attempts", "product_pages")


@register("event_scan", with_fixtures(
    f"SELECT _id, collection, product_id, viewing_product_id FROM raw_data WHERE collection IN ({G12})",
    "raw_data"))
def q_event_scan(spark: SparkSession, d: str) -> DataFrame:
    """OP-01: event scan with projection and event-name predicate."""
    raw = fx.raw_data(spark, d)
    return (raw.where(F.col("collection").isin(list(GROUP1_EVENTS + GROUP2_EVENTS)))
            .select("_id", "collection", "product_id", "viewing_product_id"))


@register("event_scan_stored", with_fixtures(
    f"SELECT _id, collection, product_id, viewing_product_id FROM raw_data WHERE collection IN ({G12})",
    "raw_data"))
def q_event_scan_stored(spark, d):
    """OP-01 on a stored table: raw_data written as Parquet, then read with the event-name
    predicate and projection pushed into the scan."""
    from clickflow.session import work_path
    from clickflow.sources.tables import read_events
    path = work_path(spark, "raw_data")
    fx.raw_data(spark, d).write.parquet(path)
    return read_events(spark, path, ["_id", "collection", "product_id", "viewing_product_id"],
                       list(GROUP1_EVENTS + GROUP2_EVENTS))


@register("full_scan", with_fixtures("SELECT * FROM raw_data", "raw_data"))
def q_full_scan(spark, d):
    """OP-02: every field of a stored table."""
    from clickflow.session import work_path
    from clickflow.sources.tables import read_table
    path = work_path(spark, "raw_data")
    fx.raw_data(spark, d).write.parquet(path)
    return read_table(spark, path)


@register("full_scan_json", with_fixtures(
    """SELECT _id, device_id, price, CAST(k AS VARCHAR) AS k, nested FROM (
  SELECT *, CASE WHEN _id > '000000000000000000000010' THEN 'late ' || store_id END AS k, '{"a":[' || store_id || ']}' AS nested FROM raw_data) z""",
    "raw_data"))
def q_full_scan_json(spark, d):
    """OP-02 on a JSON-lines export: every field of every document, also those that no schema
    names, that only later documents have, or that are nested."""
    from clickflow.session import work_path
    from clickflow.sources.tables import read_json_documents
    path = work_path(spark, "raw_json")
    raw = fx.raw_data(spark, d)
    late = F.when(F.col("_id") > "0" * 22 + "10", F.concat(F.lit("late "), F.col("store_id")))
    raw.select("_id", "device_id", "price", late.alias("late"), F.struct(F.array(F.col("store_id").cast("int")).alias("a")).alias("nested")).write.json(path)
    doc = read_json_documents(spark, path)
    get = lambda p: F.try_variant_get("doc", p, "string")
    return doc.select("_id", get("$.device_id").alias("device_id"), get("$.price").alias("price"), get("$.late").alias("k"), get("$.nested").alias("nested"))


@register("event_scan_json", with_fixtures(
    "SELECT _id, collection, product_id, viewing_product_id, current_url, referrer_url, ip, user_id_db, "
    "device_id, store_id, api_version, price, cat_id, CAST(is_paypal AS VARCHAR) AS is_paypal, ts FROM raw_data",
    "raw_data"))
def q_event_scan_json(spark, d):
    """OP-01 on a JSON-lines export (one document per line, explicit schema)."""
    from clickflow.session import work_path
    from clickflow.sources.tables import read_json_events
    path = work_path(spark, "raw_json")
    # microsecond timestamps (the JSON writer keeps milliseconds by default)
    fx.raw_data(spark, d).write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    return read_json_events(spark, path)


@register("event_groups", with_fixtures(
    f"WITH {TAGGED} SELECT _id, collection, event_group FROM tagged", "raw_data"))
def q_event_groups(spark, d):
    """OP-08: event-group filter and tag."""
    return ev.tag_event_group(fx.raw_data(spark, d)).select("_id", "collection", "event_group")


@register("resolve_product_id", with_fixtures(
    f"WITH {TAGGED}, {RESOLVED} SELECT _id, event_group, resolved_id FROM resolved", "raw_data"))
def q_resolve_product_id(spark, d):
    """OP-09: truthy fallback product id per group."""
    return ev.resolve_product_id(ev.tag_event_group(fx.raw_data(spark, d))).select("_id", "event_group", "resolved_id")


@register("resolve_url", with_fixtures(
    f"WITH {TAGGED}, {RESOLVED}, {VALID_URLS} SELECT _id, event_group, resolved_id, url FROM valid_urls",
    "raw_data"))
def q_resolve_url(spark, d):
    """OP-10: URL per group, blank and test-site URLs dropped."""
    t = ev.resolve_product_id(ev.tag_event_group(fx.raw_data(spark, d)))
    return ev.resolve_url(t, M).select("_id", "event_group", "resolved_id", "url")


@register("candidates", with_fixtures(
    f"WITH {TAGGED}, {RESOLVED}, {VALID_URLS}, {FIRST_URL.format(src='valid_urls')} "
    "SELECT product_id, url, event_group, _id FROM first_url", "raw_data"))
def q_candidates(spark, d):
    """OP-33/42: first valid URL per product, group 1 before group 2 (nothing finished)."""
    return cand.candidates(fx.raw_data(spark, d), None, M)


@register("finished_ids", with_fixtures(
    f"WITH {CLASSIFIED}, {FINAL}, {FINISHED} SELECT product_id FROM finished", *ATT))
def q_finished_ids(spark, d):
    """OP-41: success ids union 404 ids, deduplicated (from the resolved attempt log)."""
    return _finished(spark, d)


@register("finished_files", with_fixtures(
    f"WITH {CLASSIFIED}, {FINAL}, {FINISHED} SELECT product_id FROM finished", *ATT))
def q_finished_files(spark, d):
    """OP-45b then OP-03: finished ids appended as text per status, read back (strip,
    blanks dropped, union of both files, deduplicated)."""
    from clickflow.operators.sinks import append_finished, finished_paths
    from clickflow.session import work_path
    from clickflow.sources.tables import read_finished_ids
    root = work_path(spark, "finished")
    append_finished(_resolved_attempts(spark, d), root)
    return read_finished_ids(spark, *finished_paths(root))


@register("exclude_finished", with_fixtures(
    f"""WITH {CLASSIFIED}, {FINAL}, {FINISHED}, {TAGGED}
 SELECT _id, event_group, product_id, viewing_product_id FROM tagged t
 WHERE NOT EXISTS (SELECT 1 FROM finished f WHERE t.event_group = 1 AND f.product_id = t.product_id)
   AND NOT EXISTS (SELECT 1 FROM finished f WHERE f.product_id = t.viewing_product_id)""", "raw_data", *ATT))
def q_exclude_finished(spark, d):
    """OP-21: row-level exclusion of finished ids (null keys kept)."""
    t = ev.tag_event_group(fx.raw_data(spark, d))
    return cand.exclude_finished(t, _finished(spark, d)).select(
        "_id", "event_group", "product_id", "viewing_product_id")


@register("next_round", with_fixtures(
    f"""WITH {CLASSIFIED}, {FINAL}, {FINISHED}, {TAGGED}, kept AS (
 SELECT * FROM tagged t
 WHERE NOT EXISTS (SELECT 1 FROM finished f WHERE t.event_group = 1 AND f.product_id = t.product_id)
   AND NOT EXISTS (SELECT 1 FROM finished f WHERE f.product_id = t.viewing_product_id)),
 {RESOLVED.replace('FROM tagged', 'FROM kept')}, {VALID_URLS}, {FIRST_URL.format(src='valid_urls')}
 SELECT product_id, url, event_group, _id FROM first_url""", "raw_data", *ATT))
def q_next_round(spark, d):
    """OP-43: next round's work = candidates after excluding every finished id."""
    return cand.candidates(fx.raw_data(spark, d), _finished(spark, d), M)


@register("count_products", with_fixtures(
    f"WITH {TAGGED}, {RESOLVED} SELECT count(DISTINCT resolved_id) AS total_products FROM resolved",
    "raw_data"))
def q_count_products(spark, d):
    """OP-24: distinct resolved ids over both groups."""
    return cand.count_products(fx.raw_data(spark, d))


@register("pending_count", with_fixtures(
    f"""WITH {CLASSIFIED}, {FINAL}, {FINISHED}, {TAGGED}, {RESOLVED}, kept AS (
 SELECT * FROM tagged t
 WHERE NOT EXISTS (SELECT 1 FROM finished f WHERE t.event_group = 1 AND f.product_id = t.product_id)
   AND NOT EXISTS (SELECT 1 FROM finished f WHERE f.product_id = t.viewing_product_id)),
 r2 AS (SELECT *, CASE WHEN event_group = 1 THEN coalesce(nullif(product_id, ''), nullif(viewing_product_id, ''))
  ELSE nullif(viewing_product_id, '') END AS resolved_id,
  CASE WHEN event_group = 1 THEN current_url ELSE referrer_url END AS url FROM kept),
 v2 AS (SELECT * FROM r2 WHERE url IS NOT NULL AND url <> '' AND strpos(url, 'stage.shop') = 0 AND strpos(url, 'test.shop') = 0),
 t AS (SELECT count(DISTINCT resolved_id) AS total_products FROM resolved),
 f AS (SELECT count(*) AS finished FROM finished),
 e AS (SELECT count(DISTINCT resolved_id) AS pending_exact FROM v2)
 SELECT total_products, finished, total_products - finished AS pending_estimate, pending_exact FROM t, f, e""",
    "raw_data", *ATT))
def q_pending_count(spark, d):
    """OP-25: pending = distinct ids - finished (estimate) and the exact remaining work."""
    return cand.pending_count(fx.raw_data(spark, d), _finished(spark, d), M)


@register("classify_attempt", with_fixtures(
    f"WITH {CLASSIFIED} SELECT product_id, attempt, status_code, status FROM classified", *ATT))
def q_classify_attempt(spark, d):
    """OP-13: outcome class per attempt."""
    return att.classify_attempt(fx.attempts(spark, d)).select("product_id", "attempt", "status_code", "status")


@register("attempt_message", with_fixtures(
    f"WITH {CLASSIFIED} SELECT product_id, attempt, status, {MESSAGES} FROM classified", *ATT))
def q_attempt_message(spark, d):
    """OP-15: error text and HTTP code per attempt outcome."""
    c = att.attempt_message(att.classify_attempt(fx.attempts(spark, d)))
    return c.select("product_id", "attempt", "status", "http_code", "error_msg")


@register("resolve_attempts", with_fixtures(
    f"WITH {CLASSIFIED}, {FINAL} SELECT * FROM final", *ATT))
def q_resolve_attempts(spark, d):
    """OP-14: final status per item (first 200/404, else the last of 3 attempts)."""
    return _resolved_attempts(spark, d)


@register("extract_name", with_fixtures(
    f"SELECT page_id, product_id, {name_sql('html')} AS product_name FROM product_pages", "product_pages"))
def q_extract_name(spark, d):
    """OP-12: product name from captured HTML (heading span, og:title, Unknown name)."""
    return att.extract_name(fx.product_pages(spark, d)).select("page_id", "product_id", "product_name")


@register("result_log", with_fixtures(
    f"WITH {CLASSIFIED}, {FINAL}, {RESULT_LOG} SELECT * FROM result_log", *ATT_PAGES))
def q_result_log(spark, d):
    """OP-44: the six-column result log of every outcome."""
    return _result_log(spark, d)


@register("result_log_csv", with_fixtures(
    f"WITH {CLASSIFIED}, {FINAL}, {RESULT_LOG} SELECT product_id, nullif(product_name, '') AS product_name, url, "
    "status, http_code, nullif(error_msg, '') AS error_msg FROM result_log", *ATT_PAGES))
def q_result_log_csv(spark, d):
    """OP-44: the result log appended as CSV with a header and read back. CSV has one
    blank: absent fields and empty text are both written blank and read back as null."""
    from clickflow.operators.sinks import RESULT_LOG_SCHEMA, write_result_log
    from clickflow.session import work_path
    path = work_path(spark, "result-log")
    write_result_log(_result_log(spark, d), path)
    return (spark.read.schema(RESULT_LOG_SCHEMA).option("header", "true")
            .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))


@register("normalize_product", with_fixtures(
    f"WITH {CLASSIFIED}, {FINAL}, {RESULT_LOG}, {NORMALIZED} SELECT * FROM normalized", *ATT_PAGES))
def q_normalize_product(spark, d):
    """OP-16: strip/cast id, name, url of successful captures."""
    log = _result_log(spark, d).where(F.col("status") == "success")
    return dq.normalize_product(log.select("product_id", "product_name", "url"))


@register("validate_product", with_fixtures(
    f"""WITH named AS (SELECT page_id, product_id, {name_sql('html')} AS product_name, url FROM product_pages),
 normalized AS (SELECT page_id, {strip_sql('product_id')} AS product_id, {strip_sql('product_name')} AS product_name,
  {strip_sql('url')} AS url FROM named)
 SELECT *, {REASON} AS reason, {REASON} = 'valid' AS is_valid FROM normalized""", "product_pages"))
def q_validate_product(spark, d):
    """OP-17: ordered product rules over every captured page's extracted name."""
    named = att.extract_name(fx.product_pages(spark, d)).select("page_id", "product_id", "product_name", "url")
    return dq.validate_product(dq.normalize_product(named))


@register("clean_products", with_fixtures(
    f"WITH {CLASSIFIED}, {FINAL}, {RESULT_LOG}, {NORMALIZED}, {VALIDATED} "
    "SELECT product_id, product_name, url FROM validated WHERE reason = 'valid'", *ATT_PAGES))
def q_clean_products(spark, d):
    """OP-20/45: clean product rows (success + valid)."""
    clean, _ = dq.split_valid(_validated_success(spark, d))
    return clean


@register("product_rejects", with_fixtures(
    f"WITH {CLASSIFIED}, {FINAL}, {RESULT_LOG}, {NORMALIZED}, {VALIDATED} "
    "SELECT product_id, product_name, url, reason FROM validated WHERE reason <> 'valid'", *ATT_PAGES))
def q_product_rejects(spark, d):
    """OP-20: quarantined product rows with the first failing rule."""
    _, rejects = dq.split_valid(_validated_success(spark, d))
    return rejects


@register("product_names_append", with_fixtures(
    f"WITH {CLASSIFIED}, {FINAL}, {RESULT_LOG}, {NORMALIZED}, {VALIDATED} "
    "SELECT product_id, product_name, url FROM validated WHERE reason = 'valid'", *ATT_PAGES))
def q_product_names_append(spark, d):
    """OP-45: clean products appended twice (a replayed round) by product_id, read back:
    the replay adds nothing."""
    from clickflow.operators.sinks import append_products
    from clickflow.session import work_path
    path = work_path(spark, "product_names")
    clean, _ = dq.split_valid(_validated_success(spark, d))
    for _ in range(2):
        append_products(clean, path)
    return spark.read.parquet(path)


@register("outcome_counts", with_fixtures(
    f"WITH {CLASSIFIED}, {FINAL} SELECT {OUTCOMES} FROM final", *ATT))
def q_outcome_counts(spark, d):
    """OP-28: processed, success and error counters."""
    return rep.outcome_counts(_resolved_attempts(spark, d))


@register("product_quality", with_fixtures(
    f"WITH {CLASSIFIED}, {FINAL}, {RESULT_LOG}, {NORMALIZED}, {VALIDATED} SELECT {DQ} FROM validated",
    *ATT_PAGES))
def q_product_quality(spark, d):
    """OP-29: product data-quality counters."""
    return rep.product_quality(_validated_success(spark, d))


@register("crawl_report", with_fixtures(
    f"""WITH {CLASSIFIED}, {FINAL}, {RESULT_LOG}, {NORMALIZED}, {VALIDATED},
 o AS (SELECT {OUTCOMES} FROM final), q AS (SELECT {DQ} FROM validated)
 SELECT o.*, q.*, round(CASE WHEN processed = 0 THEN NULL ELSE success * 100.0 / processed END, 1) AS success_rate
 FROM o, q""", *ATT_PAGES))
def q_crawl_report(spark, d):
    """OP-30: the final capture report row."""
    return rep.crawl_report(_result_log(spark, d))


@register("chunk_progress", with_fixtures(
    f"""WITH {CLASSIFIED}, {FINAL},
 numbered AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY product_id) - 1) / 100) AS INTEGER) + 1 AS chunk FROM final),
 per AS (SELECT chunk, count(*) AS n, count(*) FILTER (WHERE status = 'success') AS n_success,
   count(*) FILTER (WHERE status = 'err_404') AS n_404,
   count(*) FILTER (WHERE status NOT IN ('success', 'err_404')) AS n_retry FROM numbered GROUP BY chunk)
 SELECT chunk, n, CAST(sum(n) OVER w AS BIGINT) AS processed, CAST(sum(n_success) OVER w AS BIGINT) AS success,
  CAST(sum(n_404) OVER w AS BIGINT) AS err_404, CAST(sum(n_retry) OVER w AS BIGINT) AS to_retry,
  CAST(sum(n) OVER () - sum(n) OVER w AS BIGINT) AS pending
 FROM per WINDOW w AS (ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", *ATT))
def q_chunk_progress(spark, d):
    """OP-36: cumulative progress per capture batch of 100 items."""
    return rep.chunk_progress(_resolved_attempts(spark, d))


@register("capture_round", with_fixtures(
    f"""WITH {TAGGED}, {RESOLVED}, {VALID_URLS}, {FIRST_URL.format(src='valid_urls')},
 {CLASSIFIED.replace('FROM attempts', 'FROM attempts WHERE product_id IN (SELECT product_id FROM first_url)')},
 {FINAL}, {RESULT_LOG} SELECT * FROM result_log""", "raw_data", *ATT_PAGES))
def q_capture_round(spark, d):
    """One capture round end to end: candidates -> their attempts -> result log."""
    from clickflow.plans.capture import capture_round
    return capture_round(fx.raw_data(spark, d), fx.attempts(spark, d), fx.product_pages(spark, d), None, M).log


# --- Several rounds, several pages per product -----------------------------------------
def _outcomes_sql(src: str, name: str) -> str:
    """Final outcome per (product, round) of the attempts ``src``, with the name on the last page
    captured not after it."""
    return f"""{name}_classified AS ({CLASSIFIED.split('(', 1)[1].rsplit(')', 1)[0].replace('FROM attempts', f'FROM {src}')}),
 {name}_final AS (SELECT product_id, round, url, status, {MESSAGES}, finished_at FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id, round ORDER BY
    CASE WHEN status IN ('success', 'err_404') OR attempt >= 3 THEN 0 ELSE 1 END,
    CASE WHEN status IN ('success', 'err_404') OR attempt >= 3 THEN attempt ELSE -attempt END) AS rn
  FROM {name}_classified) z WHERE rn = 1),
 {name}_log AS (SELECT f.product_id, f.round, CASE WHEN status = 'success' THEN regexp_extract(p.html, '<span>(.*)</span>', 1) END AS product_name,
   url, status, http_code, error_msg
  FROM {name}_final f ASOF LEFT JOIN round_pages p ON f.product_id = p.product_id AND f.round = p.round AND f.finished_at >= p.captured_at)"""


def _rounds_sql(rounds: int = 3) -> str:
    """Each round works on the candidates that no earlier round has finished."""
    ctes, done = [TAGGED], "SELECT CAST(NULL AS VARCHAR) AS product_id WHERE false"
    for r in range(1, rounds + 1):
        ctes.append(f"done{r} AS ({done})")
        ctes.append(f"""kept{r} AS (SELECT * FROM tagged t
 WHERE NOT EXISTS (SELECT 1 FROM done{r} f WHERE t.event_group = 1 AND f.product_id = t.product_id)
   AND NOT EXISTS (SELECT 1 FROM done{r} f WHERE f.product_id = t.viewing_product_id))""")
        ctes.append(RESOLVED.replace("resolved AS", f"resolved{r} AS").replace("FROM tagged", f"FROM kept{r}"))
        ctes.append(VALID_URLS.replace("valid_urls AS", f"valid{r} AS").replace("FROM resolved", f"FROM resolved{r}"))
        ctes.append(f"tried{r} AS (SELECT * FROM attempt_rounds WHERE round = {r} AND product_id IN (SELECT resolved_id FROM valid{r}))")
        ctes.append(_outcomes_sql(f"tried{r}", f"r{r}"))
        done += f" UNION SELECT product_id FROM r{r}_final WHERE status IN ('success', 'err_404')"
    logs = " UNION ALL ".join(f"SELECT * FROM r{r}_log" for r in range(1, rounds + 1))
    return f"WITH {', '.join(ctes)} SELECT round, product_id, product_name, url, status, http_code, nullif(error_msg, '') AS error_msg FROM ({logs}) l"


ROUND_VIEWS = ("attempt_rounds", "round_pages")


@register("outcome_pages", with_fixtures(f"WITH {_outcomes_sql('attempt_rounds', 'a')} SELECT * FROM a_log", *ROUND_VIEWS))
def q_outcome_pages(spark, d):
    """OP-44/05: outcome of every product and round with the name on its own page: the last one
    captured not after the outcome (as-of join), whatever the other attempts captured."""
    resolved = att.resolve_attempts(fx.attempt_rounds(spark, d), by=["round"])
    return att.result_log(resolved, fx.round_pages(spark, d))


@register("capture_rounds", with_fixtures(_rounds_sql(), "raw_data", *ROUND_VIEWS))
def q_capture_rounds(spark, d):
    """OP-43/44: three capture rounds end to end, each with its own attempts and pages and without what
    the rounds before finished; the stored result log read back (blank fields as null)."""
    from clickflow.operators.sinks import RESULT_LOG_SCHEMA
    from clickflow.plans.capture import run_capture
    from clickflow.session import work_path
    root = work_path(spark, "capture-rounds")
    run_capture(spark, fx.raw_data(spark, d), fx.attempt_rounds(spark, d), fx.round_pages(spark, d), root, M, rounds=3)
    log = (spark.read.schema(RESULT_LOG_SCHEMA + ", run int, round int").option("header", "true").option("ignoreLeadingWhiteSpace", "false")
           .option("ignoreTrailingWhiteSpace", "false").csv(f"{root}/result_log"))
    return log.select("round", "product_id", "product_name", "url", "status", "http_code", "error_msg")
