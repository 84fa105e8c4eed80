"""Capture plan: candidates -> attempt outcomes -> names -> quality -> sinks, in rounds.

Fetching is replaced by inputs: an attempt log (one row per HTTP attempt) and the
captured pages. Within a round every step after candidate selection is keyed by
product_id, so the candidates' partitioning is reused by the semi-join, the attempt
resolution and the page join."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.config import MAX_ATTEMPTS, MAX_ROUNDS
from clickflow.operators import attempts as att
from clickflow.operators import candidates as cand
from clickflow.operators import quality as dq
from clickflow.operators import reports as rep
from clickflow.operators import sinks
from clickflow.session import work_path
from clickflow.sources import commits, fs


@dataclass
class CaptureRound:
    candidates: DataFrame
    log: DataFrame
    validated: DataFrame
    clean: DataFrame
    rejects: DataFrame
    report: DataFrame


def _of_round(df: DataFrame, round_no: int | None) -> DataFrame:
    """The rows of one round, where the table tells rounds apart."""
    return df.where(F.col("round") == F.lit(round_no)).drop("round") if round_no is not None and "round" in df.columns else df


def capture_round(raw: DataFrame, attempts: DataFrame, pages: DataFrame, finished: DataFrame | None,
                  markers: Sequence[str] = (), max_attempts: int = MAX_ATTEMPTS,
                  round_no: int | None = None, state: DataFrame | None = None) -> CaptureRound:
    """One round over the work left: candidates not finished, their final outcome, the
    six-column result log, validated names and the report row. When the attempt log or the pages
    have a ``round`` column, only this round's rows count (``round_no``). With ``state`` (a
    ``work_state`` of the events) the events are not scanned again."""
    cands = cand.candidates(raw, finished, markers) if state is None else cand.state_candidates(state, finished)
    attempts, pages = _of_round(attempts, round_no), _of_round(pages, round_no)
    tried = attempts.join(cands.select("product_id"), "product_id", "left_semi")
    resolved = att.resolve_attempts(tried, max_attempts)
    log = att.result_log(resolved, pages)
    success = log.where(F.col("status") == "success").select("product_id", "product_name", "url")
    validated = dq.validate_product(dq.normalize_product(success))
    clean, rejects = dq.split_valid(validated)
    return CaptureRound(cands, log, validated, clean, rejects, rep.crawl_report(log))


def finished_rows(rnd: CaptureRound, retry_invalid: bool = False, log: DataFrame | None = None,
                  rejects: DataFrame | None = None) -> DataFrame:
    """Result rows that finish their item. By default a success finishes the item even
    when its name fails validation (it is never fetched again); with ``retry_invalid``
    such items stay open for the next round."""
    return _final_rows(rnd.log if log is None else log, rnd.rejects if rejects is None else rejects, retry_invalid)


def _final_rows(log: DataFrame, rejects: DataFrame, retry_invalid: bool) -> DataFrame:
    if not retry_invalid:
        return log
    bad = rejects.select(F.col("product_id").alias("_bad"))
    return log.join(bad, (log["product_id"] == bad["_bad"]) & (log["status"] == "success"), "left_anti")


def _judged(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean products and rejects of a log."""
    success = log.where(F.col("status") == "success").select("product_id", "product_name", "url")
    return dq.split_valid(dq.validate_product(dq.normalize_product(success)))


def round_folder(root: str, sink: str, run: int, round_no: int) -> str:
    return f"{root.rstrip('/')}/{sink}/run={run}/round={round_no}"


def _finish(spark: SparkSession, root: str, version: int, doc: dict, retry_invalid: bool) -> int:
    """Append the finished ids of a logged round, commit that and drop the round's rows; the new version."""
    log = spark.read.parquet(doc["rows"])
    sinks.append_finished(_final_rows(log, _judged(log)[1], retry_invalid), f"{root}/finished")
    commits.commit(spark, f"{root}/_rounds", version + 1, doc | {"step": "finished"})
    fs.delete(spark, doc["rows"])
    return version + 1


def run_capture(spark: SparkSession, raw: DataFrame, attempts: DataFrame, pages: DataFrame, out_root: str,
                markers: Sequence[str] = (), rounds: int = MAX_ROUNDS, retry_invalid: bool = False) -> list[dict]:
    """Up to ``rounds`` rounds. The events are scanned once per run (``work_state``). Each round
    reads the finished ids written so far and writes the result log and the rejects to folders of its own
    (``run=<n>/round=<n>``), the clean products (insert-only by product_id) and then its
    finished ids. With a ``round`` column in the attempt log each round uses its own attempts (and
    pages, if they have the column); without one there is one round, as a second would repeat the first.

    Every round commits two documents below ``_rounds``: "logged" when its folders and products
    are whole, "finished" when its ids are appended. A run that was cut off goes on where it
    stopped: a round that was not logged replaces its folders, a logged one appends its ids from the stored
    rows, and no outcome is stored twice or lost. Returns one report per round of this call (the original's pending
    estimate as ``total``, the counters observed on the log write, and the capture report with
    its data-quality counters and rates)."""
    from clickflow.sources.tables import read_finished_ids
    root = out_root.rstrip("/")
    reports = []
    per_round = "round" in attempts.columns
    version, doc = commits.head(spark, f"{root}/_rounds")
    if doc and doc["step"] == "logged":
        version = _finish(spark, root, version, doc, retry_invalid)
    cut_off = bool(doc) and doc["round"] < doc["rounds"]
    run = doc["run"] + (0 if cut_off else 1) if doc else 1
    # without a round column every round would read the same attempts again
    last = doc["rounds"] if cut_off else rounds if per_round else 1
    path = work_path(spark, "work-state")
    cand.work_state(raw, markers).write.parquet(path)   # one event scan for all rounds
    try:
        state = spark.read.parquet(path)
        products = state.select("resolved_id").distinct().count()
        for r in range(doc["round"] + 1 if cut_off else 1, last + 1):
            finished = read_finished_ids(spark, *sinks.finished_paths(f"{root}/finished"))
            # the original's "total": distinct ids minus finished ids (an estimate)
            total = products - cand.finished_union(finished).count()
            rnd = capture_round(raw, attempts, pages, finished, markers, round_no=r if per_round else None, state=state)
            # computed once: all sinks, also after a crash, read these rows
            doc = {"run": run, "round": r, "rounds": last, "step": "logged", "rows": work_path(spark, "round-rows")}
            rnd.log.write.parquet(doc["rows"])
            log = spark.read.parquet(doc["rows"])
            counters = sinks.write_result_log(log, round_folder(root, "result_log", run, r), mode="overwrite") or {}
            clean, rejects = _judged(log)
            sinks.append_rejects(rejects, round_folder(root, "product_rejects", run, r), mode="overwrite")
            sinks.append_products(clean, f"{root}/product_names")
            report = rep.crawl_report(log).first().asDict()
            version += 1
            commits.commit(spark, f"{root}/_rounds", version, doc)
            version = _finish(spark, root, version, doc, retry_invalid)
            reports.append({"round": r, "total": total, **counters, **report})
    finally:
        fs.delete(spark, path)
    return reports
