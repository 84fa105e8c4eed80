"""Fetch-attempt outcomes: classify each attempt, resolve each item's final status,
derive the message/HTTP code, and extract product names from captured pages.

Live fetching is not done here: the input is an attempt log
(product_id, url, attempt, status_code, error_kind[, error_msg, round, finished_at]) and a
table of captured pages (product_id, html[, round, attempt, captured_at])."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.config import MAX_ATTEMPTS, MSG_403, MSG_404, MSG_429, UNKNOWN_NAME
from clickflow.functions.html import extract_product_name
from clickflow.operators.asof import asof_join

#: Optional columns: the time of an attempt, and the time a page was captured.
FINISHED_AT, CAPTURED_AT = "finished_at", "captured_at"


def attempt_class(code: Column, kind: Column) -> Column:
    """Outcome class of one attempt from its HTTP code / failure kind."""
    return (F.when(code == 200, "success")
            .when(code == 404, "err_404")
            .when(code == 403, "err_403")
            .when(code == 429, "err_429")
            .when(code.between(500, 599), "err_5xx")
            .when(code.isNull() & (kind == "network"), "err_network")
            .otherwise("err_other"))


def classify_attempt(df: DataFrame, code_col: str = "status_code", kind_col: str = "error_kind",
                     out: str = "status") -> DataFrame:
    return df.withColumn(out, attempt_class(F.col(code_col), F.col(kind_col)))


def attempt_message(df: DataFrame, status_col: str = "status", code_col: str = "status_code",
                    kind_col: str = "error_kind", msg_col: str | None = None) -> DataFrame:
    """Add ``http_code`` and ``error_msg`` per outcome class:
    fixed text for 404/403/429, ``HTTP <code>`` for 5xx and unlisted codes, the failure
    text for exceptions; http_code is 0 for a non-network exception and null for a
    network failure."""
    st, code = F.col(status_col), F.col(code_col)
    failure_text = F.col(msg_col) if msg_col and msg_col in df.columns else F.col(kind_col)
    is_exception = code.isNull()
    http_code = (F.when(st == "err_network", F.lit(None).cast("int"))
                 .when(is_exception, F.lit(0))
                 .otherwise(code.cast("int")))
    msg = (F.when(st == "success", F.lit(""))
           .when(st == "err_404", F.lit(MSG_404))
           .when(st == "err_403", F.lit(MSG_403))
           .when(st == "err_429", F.lit(MSG_429))
           .when(is_exception, F.coalesce(failure_text.cast("string"), F.lit("")))
           .otherwise(F.concat(F.lit("HTTP "), code.cast("string"))))
    return df.withColumn("http_code", http_code).withColumn("error_msg", msg)


def resolve_attempts(df: DataFrame, max_attempts: int = MAX_ATTEMPTS, id_col: str = "product_id",
                     by: Sequence[str] = ()) -> DataFrame:
    """Final outcome per item (and per value of the columns ``by``, e.g. the round). Attempts stop
    at the first 200/404; any other outcome is retried until ``max_attempts``; the final status is the
    class of the last attempt made. Implemented as ``min(struct(rank...))`` per item: decomposable, so
    it is partially aggregated before the shuffle.

    Output: product_id, url, attempts (number made), status, http_code, error_msg, ``by``, and
    ``finished_at`` (time of that attempt) when the log has it."""
    c = classify_attempt(df)
    terminal = F.col("status").isin("success", "err_404") | (F.col("attempt") >= max_attempts)
    has_msg = "error_msg" in df.columns
    payload = [F.col("attempt").alias("attempt"), F.col("status").alias("status"),
               F.col("status_code").alias("status_code"), F.col("error_kind").alias("error_kind"),
               F.col("url").alias("url")]
    more = [c for c in ("error_msg", FINISHED_AT) if c in df.columns]
    payload += [F.col(c).alias(c) for c in more]
    key = F.struct(
        F.when(terminal, F.lit(0)).otherwise(F.lit(1)).alias("nt"),
        # terminal: earliest wins; no terminal attempt logged: latest wins
        F.when(terminal, F.col("attempt")).otherwise(-F.col("attempt")).alias("ord"),
        *payload,
    )
    best = (c.groupBy(F.col(id_col).cast("string").alias("product_id"), *by)
            .agg(F.min(key).alias("_b"))
            .select("product_id", *by, "_b.*")
            .withColumnRenamed("attempt", "attempts")
            .drop("nt", "ord"))
    out = attempt_message(best, msg_col="error_msg" if has_msg else None)
    times = [FINISHED_AT] if FINISHED_AT in more else []
    return out.select("product_id", "url", "attempts", "status", "http_code", "error_msg", *by, *times)


def extract_name(df: DataFrame, html_col: str = "html", out: str = "product_name",
                 method: str = "regex") -> DataFrame:
    """Product name from the page: heading span, else og:title, else 'Unknown name'.
    ``method="regex"`` stays in the JVM (default); ``"parser"`` uses the HTML parser in
    an Arrow-batched pandas UDF for markup the regex cannot follow (nested spans)."""
    if method == "parser":
        from clickflow.functions.html_parser import extract_product_name_parsed
        return df.withColumn(out, extract_product_name_parsed(F.col(html_col)))
    return df.withColumn(out, extract_product_name(F.col(html_col)))


def result_log(resolved: DataFrame, pages: DataFrame, method: str = "regex") -> DataFrame:
    """The six-column result log: every outcome, product_name only for successes
    (extracted from the captured page), absent fields null; plus ``round`` if ``resolved`` has it.

    One row per item whatever the number of captured pages. A page belongs to an outcome by all
    the keys that both sides have: product, ``round``, ``attempt``. Pages without an attempt but with
    ``captured_at`` belong to the outcome whose time (``finished_at``) they precede most closely: the
    last capture not after it counts (``asof_join``). Pages that are still several (one attempt
    captured twice, or no key at all) give one name: a found name before the fallback text, then the least.

    Names are extracted on the page side, in the scan of the pages, so only keys and names
    are shuffled, never the HTML; ``resolved`` is read once."""
    keys = ["product_id", *(["round"] if {"round"} <= set(resolved.columns) & set(pages.columns) else [])]
    timed = "attempt" not in pages.columns and CAPTURED_AT in pages.columns and FINISHED_AT in resolved.columns
    extra = {"attempt": "attempts"} if "attempt" in pages.columns else {CAPTURED_AT: FINISHED_AT} if timed else {}
    named = extract_name(pages, "html", "_one", method).select(
        F.col("product_id").cast("string").alias("_k_product_id"), *[F.col(c).alias(f"_k_{c}") for c in [*keys[1:], *extra]], "_one")
    best = F.min(F.struct((F.col("_one") == F.lit(UNKNOWN_NAME)).alias("u"), F.col("_one").alias("n")))
    marks = [f"_k_{c}" for c in [*keys, *extra]]
    names = named.groupBy(*marks).agg(best.alias("_b")).select(*marks, F.col("_b.n").alias("_name"))
    won = F.col("status") == "success"
    out = ["product_id", F.when(won, F.col("_name")).alias("product_name"), "url", "status", "http_code", "error_msg",
           *(["round"] if "round" in resolved.columns else [])]
    if timed:
        sides = names.select(*[F.col(f"_k_{c}").alias(c) for c in keys], F.col(f"_k_{CAPTURED_AT}").alias("_at"), "_name")
        return asof_join(resolved, sides, keys, FINISHED_AT, "_at", "_name", out="_name").select(*out)
    on = F.lit(True)
    for c in [*keys, *extra]:
        on = on & (resolved[extra.get(c, c)] == names[f"_k_{c}"])
    return resolved.join(names, on, "left").select(*out)
