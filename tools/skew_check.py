"""Hot-key check from Spark's event log.

Builds a stress form of the events feed in which one key carries a third of
all events (every third event is re-keyed to user 0), runs the per-key
operators on it, and reads the event log (written to a fresh scratch
folder) to report, per operator, the largest share of a stage's records
that one task processed.  With 16 shuffle partitions an even spread is
~6%; a key of one third in one task would show >= 33%.

usage: python tools/skew_check.py [sf_dir]
"""
from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="tidemark-eventlog-")
    from pyspark.sql import SparkSession, Window
    from pyspark.sql import functions as F

    spark = (SparkSession.builder.master("local[8]").appName("skew-check")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from tidemark.contracts import FEED
    from tidemark.operators import fold as fm
    from tidemark.operators import history
    from tidemark.session import configure
    from tidemark.sources import testdata as td
    configure(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")

    ev = td.read(spark, sf_dir, "events")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    feed = td.encode_feed(td.feed_columns(hot), "patch")
    accounts = feed.where(F.col("table_name") == "accounts")
    t = FEED.table("accounts")
    steps = {
        "fold": lambda: fm.fold(accounts, t),
        "key_history": lambda: history.key_history(accounts),
        "scd2": lambda: history.scd2(accounts, t),
        "event_states": lambda: history.event_states(accounts, t),
        # contrast: a plain per-key window, as the library does NOT do it
        "plain_window_baseline": lambda: accounts.withColumn("rn", F.row_number().over(
            Window.partitionBy("primary_key").orderBy("sequence"))),
    }
    sc = spark.sparkContext
    for name, build in steps.items():
        sc.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_group, task_records = {}, defaultdict(list)
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                kind = e.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for s in e.get("Stage IDs", []):
                        stage_group[s] = group
                elif kind == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    recs = (m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                            + m.get("Input Metrics", {}).get("Records Read", 0))
                    task_records[e["Stage ID"]].append(recs)
    worst = {}
    for stage, recs in task_records.items():
        group, total = stage_group.get(stage), sum(recs)
        if group is None or total < 1000 or len(recs) < 2:
            continue
        share = max(recs) / total
        if share > worst.get(group, (0, 0, 0))[0]:
            worst[group] = (round(share, 3), len(recs), total)
    print(json.dumps({"hot_key_share": 1 / 3, "event_log": log_dir,
                      "max_task_share_per_step": {k: {"share": v[0], "tasks": v[1], "records": v[2]}
                                                  for k, v in worst.items()}}, indent=1))


if __name__ == "__main__":
    main()
