"""Skew probe: per-task shuffle-read records of first-URL-wins when one product holds a
third of the events: min(struct) partial aggregate, the row_number()=1 window (which
Spark 4 pre-reduces with a partial group limit), and that window with the group limit
switched off.

Reads Spark's event log from a scratch folder (no UI). usage:
  python tools/skew_probe.py [sf_dir] [scratch_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="run-skew-")
    from pyspark.sql import SparkSession, Window
    from pyspark.sql import functions as F

    spark = (SparkSession.builder.master("local[8]").appName("skew-probe")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", scratch)
             .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.enabled", "false")      # keep the 16 reduce tasks visible
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from clickflow.operators import candidates as cand
    from clickflow.operators import events as ev
    from clickflow.sources import fixtures as fx

    raw = fx.raw_data(spark, sf)
    hot = raw.withColumn("product_id", F.when(F.col("_id").substr(24, 1).isin("0", "3", "6"), F.lit("HOT"))
                         .otherwise(F.col("product_id")))
    hot = hot.repartition(16).persist()
    hot.count()

    def window_version(df):
        t = ev.resolve_url(ev.resolve_product_id(ev.tag_event_group(df)))
        w = Window.partitionBy("resolved_id").orderBy("event_group", "_id")
        return t.where(F.col("resolved_id").isNotNull()).withColumn("rn", F.row_number().over(w)).where("rn = 1")

    spark.sparkContext.setJobGroup("min_struct", "min_struct")
    cand.candidates(hot).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("row_number", "row_number")
    window_version(hot).write.format("noop").mode("overwrite").save()
    # the same window without Spark's partial group limit before the shuffle
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "-1")
    spark.sparkContext.setJobGroup("row_number_no_group_limit", "row_number_no_group_limit")
    window_version(hot).write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_group, reads = {}, {}
    for path in [p for p in glob.glob(os.path.join(scratch, "**", "*"), recursive=True) if os.path.isfile(p)]:
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    group = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e.get("Stage IDs", []):
                        stage_group[sid] = group
                elif e["Event"] == "SparkListenerTaskEnd":
                    m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    n = m.get("Total Records Read", 0)
                    if n:
                        reads.setdefault(e["Stage ID"], []).append(n)
    out = {}
    last = {}
    for sid in reads:                       # the reduce stage = the group's last shuffle-reading stage
        g = stage_group.get(sid)
        if g and sid > last.get(g, -1):
            last[g] = sid
    for g, sid in last.items():
        rs = reads[sid]
        out[g] = {"stage": sid, "tasks": len(rs), "max_task_records": max(rs),
                  "median_task_records": statistics.median(rs), "total_records": sum(rs)}
    print(json.dumps({"scratch": scratch, **out}))


if __name__ == "__main__":
    main()
