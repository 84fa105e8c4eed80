"""Command line: the pipelines of the original scripts as Spark jobs.

  python -m clickflow capture    --events P --attempts P --pages P --out DIR [--marker M ...]
  python -m clickflow iplocate   --events P --ranges P [--ranges-format csv] --out P
  python -m clickflow export     --root DIR --table NAME=PATH [--table ...] [--key _id] [--size N]
  python -m clickflow load       --root DIR --table NAME [--table ...] --location-root DIR
  python -m clickflow stream-load --root DIR --table NAME --target T --target-path P --checkpoint P
  python -m clickflow profile    --events P

Each prints a JSON summary. The session is whatever ``spark-submit`` configured; run
directly, a local session is created.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from clickflow.session import local_session
    return local_session()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="clickflow")
    sub = ap.add_subparsers(dest="cmd", required=True)

    c = sub.add_parser("capture")
    c.add_argument("--events", required=True)
    c.add_argument("--attempts", required=True)
    c.add_argument("--pages", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--marker", action="append", default=[])
    c.add_argument("--rounds", type=int, default=3)
    c.add_argument("--retry-invalid", action="store_true")

    i = sub.add_parser("iplocate")
    i.add_argument("--events", required=True)
    i.add_argument("--ranges", required=True)
    i.add_argument("--ranges-format", default="parquet")
    i.add_argument("--out", required=True)

    e = sub.add_parser("export")
    e.add_argument("--root", required=True)
    e.add_argument("--table", action="append", required=True, help="NAME=PATH")
    e.add_argument("--key", default="_id")
    e.add_argument("--size", type=int, default=250_000)

    lo = sub.add_parser("load")
    lo.add_argument("--root", required=True)
    lo.add_argument("--table", action="append", required=True)
    lo.add_argument("--location-root", required=True)

    s = sub.add_parser("stream-load")
    s.add_argument("--root", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--target", required=True)
    s.add_argument("--target-path", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--key", default="_id")
    s.add_argument("--max-files-per-trigger", type=int, default=None)

    p = sub.add_parser("profile")
    p.add_argument("--events", required=True)
    p.add_argument("--approximate", action="store_true")

    a = ap.parse_args(argv)
    spark = _session()
    out: object
    if a.cmd == "capture":
        from clickflow.plans.capture import run_capture
        out = run_capture(spark, spark.read.parquet(a.events), spark.read.parquet(a.attempts),
                          spark.read.parquet(a.pages), a.out, a.marker, a.rounds, a.retry_invalid)
    elif a.cmd == "iplocate":
        from clickflow.plans.iplocate import run_ip_locations
        from clickflow.sources.tables import read_ip_ranges
        out = run_ip_locations(spark, spark.read.parquet(a.events),
                               read_ip_ranges(spark, a.ranges, a.ranges_format), a.out)
    elif a.cmd == "export":
        from clickflow.plans.multi_table import export_tables
        tables = dict(t.split("=", 1) for t in a.table)
        m = export_tables(spark, {k: spark.read.parquet(v) for k, v in tables.items()}, a.root, a.key, a.size)
        out = m.groupBy("table_name").count().toPandas().to_dict("records")
    elif a.cmd == "load":
        from clickflow.operators.warehouse import load_full
        locs = {t: f"{a.location_root.rstrip('/')}/{t}" for t in a.table}
        out = load_full(spark, a.root, a.table, locs).toPandas().to_dict("records")
    elif a.cmd == "stream-load":
        from clickflow.streaming.load import load_available
        out = {"input_rows": load_available(spark, a.root, a.table, a.target, a.target_path, a.checkpoint,
                                            a.key, a.max_files_per_trigger)}
    else:
        from clickflow.config import ProfileConfig
        from clickflow.operators.profile import profile
        out = profile(spark.read.parquet(a.events), ProfileConfig(approximate=a.approximate)).first().asDict()
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
