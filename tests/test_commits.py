"""Commit documents, several rounds of pages, and capture runs that are cut off at any step."""

import pytest

from clickflow.operators import attempts as att
from clickflow.operators import candidates as cand
from clickflow.operators import sinks
from clickflow.plans import capture
from clickflow.session import work_path
from clickflow.sources import commits, fixtures as fx, fs
from clickflow.sources.tables import read_finished_ids
from conftest import SF_SMALL, plan_text, rows


def test_commits_are_exclusive_and_complete(spark):
    folder = work_path(spark, "t-commits")
    assert commits.head(spark, folder) == (0, None)
    commits.commit(spark, folder, 1, {"a": 1})
    with pytest.raises(commits.CommitConflict):      # the other writer of version 1
        commits.commit(spark, folder, 1, {"a": 2})
    commits.commit(spark, folder, 2, {"a": "é\n"})
    with pytest.raises(commits.CommitConflict):      # a writer that came too late
        commits.commit(spark, folder, 1, {"a": 3})
    assert commits.head(spark, folder) == (2, {"a": "é\n"})
    fs.create_text(spark, f"{folder}/{3:012d}.json", '{"a": 4}')          # cut off before the seal
    assert commits.head(spark, folder) == (2, {"a": "é\n"})
    with pytest.raises(commits.CommitConflict):      # perhaps still being written
        commits.commit(spark, folder, 3, {"a": 5})
    commits.commit(spark, folder, 3, {"a": 5}, lease=-1)
    assert commits.head(spark, folder) == (3, {"a": 5})


def test_page_belongs_to_its_round_and_attempt(spark):
    log = spark.createDataFrame(
        [(1, "1", "u", 1, 403, None, 100), (1, "1", "u", 2, 403, None, 200), (1, "1", "u", 3, 403, None, 300),
         (2, "1", "u", 1, 200, None, 400), (2, "1", "u", 2, 500, None, 500), (1, "2", "v", 1, 200, None, 150), (2, "2", "v", 1, 200, None, 450)],
        "round int, product_id string, url string, attempt int, status_code int, error_kind string, finished_at long")
    page = lambda t: f"<h1 class='page-title'><span>{t}</span></h1>"
    pages = spark.createDataFrame(
        [(1, "1", 1, 99, page("Access denied")), (2, "1", 1, 398, page("Mouse")), (2, "1", 2, 499, page("Busy")), (1, "2", 1, 150, page("Ring")),
         (2, "2", 1, 449, "<p>none</p>"), (2, "2", 1, 449, page("Ring 2"))], "round int, product_id string, attempt int, captured_at long, html string")
    want = [("1", 1, None), ("1", 2, "Mouse"), ("2", 1, "Ring"), ("2", 2, "Ring 2")]
    resolved = att.resolve_attempts(log, by=["round"])
    for known in (pages, pages.drop("attempt"), pages.drop("captured_at"), pages.drop("round", "attempt")):
        assert rows(att.result_log(resolved, known), "product_id", "round", "product_name") == want, known.columns
    # without any time the round's pages of all attempts are candidates: still one row per outcome
    assert att.result_log(resolved, pages.drop("attempt", "captured_at")).count() == 4


def test_outcomes_are_resolved_once(spark):
    text = plan_text(att.result_log(att.resolve_attempts(fx.attempts(spark, SF_SMALL)), fx.product_pages(spark, SF_SMALL)))
    assert text.count("Scan parquet") // 2 == 2 or text.count("Scan parquet") == 2  # tree and details: attempts and pages once each


def _outputs(spark, root):
    log = spark.read.option("header", "true").csv(f"{root}/result_log")
    rejects = spark.read.parquet(f"{root}/product_rejects")
    return (rows(log, "run", "round", "product_id", "product_name", "status"), rows(spark.read.parquet(f"{root}/product_names")),
            rows(rejects, "run", "round", "product_id", "reason"),
            rows(read_finished_ids(spark, *sinks.finished_paths(f"{root}/finished"))))


#: (step, killed after it): each place between two steps once.
STEPS = [("write_result_log", False), ("write_result_log", True), ("append_rejects", True), ("append_products", True), ("commit logged", True),
         ("append_finished", True), ("commit finished", True)]


def test_capture_run_survives_a_kill_between_any_two_steps(spark, monkeypatch):
    path = work_path(spark, "t-inputs")
    for name, df in (("raw", fx.raw_data(spark, SF_SMALL)), ("attempts", fx.attempt_rounds(spark, SF_SMALL)), ("pages", fx.round_pages(spark, SF_SMALL))):
        df.coalesce(1).write.parquet(f"{path}/{name}")
    args = [spark.read.parquet(f"{path}/{name}") for name in ("raw", "attempts", "pages")]
    run = lambda root: capture.run_capture(spark, *args, root, rounds=2)
    whole = work_path(spark, "t-whole")
    run(whole)
    want = _outputs(spark, whole)
    assert want[0] and want[1]

    class Killed(Exception):
        pass

    for step, after in STEPS:
        root = work_path(spark, "t-killed")
        with monkeypatch.context() as m:
            if step.startswith("commit"):
                real = commits.commit

                def cut(sp, folder, version, doc, *a, real=real, step=step):
                    real(sp, folder, version, doc, *a)
                    if doc["step"] == step.split()[1]:
                        raise Killed
                m.setattr(capture.commits, "commit", cut)
            else:
                real = getattr(sinks, step)

                def cut(*a, real=real, after=after, **k):
                    if after:
                        real(*a, **k)
                    raise Killed
                m.setattr(capture.sinks, step, cut)
            with pytest.raises(Killed):
                run(root)
        run(root)
        assert _outputs(spark, root) == want, (step, after)


def test_two_capture_runs_at_once_conflict(spark, monkeypatch):
    """Another run commits the same round first: this one fails, nothing is stored twice."""
    args = (fx.raw_data(spark, SF_SMALL), fx.attempts(spark, SF_SMALL), fx.product_pages(spark, SF_SMALL))
    root = work_path(spark, "t-two")
    real = sinks.append_products

    def overtaken(*a, **k):
        real(*a, **k)
        if commits.head(spark, f"{root}/_rounds")[0] == 0:
            commits.commit(spark, f"{root}/_rounds", 1, {"run": 1, "round": 1, "rounds": 1, "step": "finished", "rows": ""})
    monkeypatch.setattr(capture.sinks, "append_products", overtaken)
    with pytest.raises(commits.CommitConflict):
        capture.run_capture(spark, *args, root)


def test_state_gives_the_candidates_of_the_events(spark):
    raw = fx.raw_data(spark, SF_SMALL)
    state = cand.work_state(raw, ["stage.shop"])
    ids = spark.createDataFrame([(str(i),) for i in range(100, 4000, 7)], "product_id string")
    cols = ["product_id", "url", "event_group", "_id"]
    assert rows(cand.state_candidates(state), *cols) == rows(cand.candidates(raw, None, ["stage.shop"]), *cols)
    for limit in (0, 1 << 26):
        assert rows(cand.state_candidates(state, ids, limit), *cols) == rows(cand.candidates(raw, ids, ["stage.shop"]), *cols)
    assert plan_text(cand.pending_count(raw, ids)).count("Scan parquet") <= 2    # tree and details: one event scan
    got = cand.pending_count(raw, ids, ["stage.shop"]).first()
    assert got["total_products"] == cand.count_products(raw).first()[0]
    assert got["pending_exact"] == cand.candidates(raw, ids, ["stage.shop"]).count()
    assert got["finished"] == ids.count() and got["pending_estimate"] == got["total_products"] - got["finished"]
