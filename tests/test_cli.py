"""Command line over files written from the fixtures."""

import json

from clickflow.__main__ import main
from clickflow.session import work_path
from clickflow.sources import fixtures as fx
from conftest import SF_SMALL


def test_cli_iplocate_and_profile(spark, capsys):
    ev = work_path(spark, "cli-events")
    rg = work_path(spark, "cli-ranges")
    fx.raw_data(spark, SF_SMALL).write.parquet(ev)
    fx.ip_ranges(spark, SF_SMALL).write.parquet(rg)
    out = work_path(spark, "cli-ip")
    assert main(["iplocate", "--events", ev, "--ranges", rg, "--out", out]) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["total"] == sum(res[k] for k in ("dq_valid", "dq_missing_ip", "dq_missing_location_info", "dq_invalid_ip"))
    assert main(["profile", "--events", ev]) == 0
    prof = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert prof["total_rows"] == spark.read.parquet(ev).count()


def test_cli_export_then_load(spark, capsys):
    ev = work_path(spark, "cli-events2")
    fx.raw_data(spark, SF_SMALL).write.parquet(ev)
    root = work_path(spark, "cli-export")
    assert main(["export", "--root", root, "--table", f"raw_data={ev}", "--size", "250"]) == 0
    capsys.readouterr()
    assert main(["load", "--root", root, "--table", "raw_data", "--location-root", work_path(spark, "cli-wh")]) == 0
    rep = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert rep[0]["status"] == "loaded" and rep[0]["rows"] == spark.read.parquet(ev).count()


def test_cli_capture_and_stream_load(spark, capsys):
    ev = work_path(spark, "cli-ev3")
    at = work_path(spark, "cli-att")
    pg = work_path(spark, "cli-pages")
    fx.raw_data(spark, SF_SMALL).write.parquet(ev)
    fx.attempts(spark, SF_SMALL).write.parquet(at)
    fx.product_pages(spark, SF_SMALL).write.parquet(pg)
    out = work_path(spark, "cli-capture")
    assert main(["capture", "--events", ev, "--attempts", at, "--pages", pg, "--out", out,
                 "--marker", "stage.shop", "--marker", "test.shop", "--rounds", "2"]) == 0
    reps = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert reps[0]["round"] == 1 and reps[0]["processed"] >= reps[0]["success"]
    root = work_path(spark, "cli-export3")
    assert main(["export", "--root", root, "--table", f"raw_data={ev}", "--size", "300"]) == 0
    capsys.readouterr()
    import uuid
    target = f"t_cli_{uuid.uuid4().hex[:8]}"
    assert main(["stream-load", "--root", root, "--table", "raw_data", "--target", target,
                 "--target-path", work_path(spark, target), "--checkpoint", work_path(spark, target + "_ck")]) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["input_rows"] == spark.read.parquet(ev).count() == spark.table(target).count()
