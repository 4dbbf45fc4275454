"""Measure how the largest task's share of the rows compares between the
skew-safe operators and plain per-key windows, on rows where one key holds
a third of the data.

Spark's event log is written to a fresh scratch folder; for each operator
the shuffle-read records of every task are summed per stage and the stage
with the most records is reported: total records, the largest task's
records, and its share.  A share near 1/3 means one task did the hot key's
work alone.

    python tools/skew_report.py [rows] [partitions]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from skyframe.operators.ranking import first_per_key, global_rank, next_in_group  # noqa: E402
from skyframe.session import build_session  # noqa: E402


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    parts = int(sys.argv[2]) if len(sys.argv) > 2 else 16
    logdir = tempfile.mkdtemp(prefix="skyframe-eventlog-")
    spark = build_session(shuffle_partitions=parts, app_name="skew-report",
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
                                 "spark.eventLog.compress": "false",
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    sc = spark.sparkContext
    base = (spark.range(0, rows, numPartitions=parts)
            .select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
                    ((F.col("id") * 7919) % 100_000).alias("t"), F.col("id"),
                    F.when(F.col("id") % 5 == 0, F.lit("error")).otherwise(F.lit("ok")).alias("s")))

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    runs = {
        "window_first_per_key": lambda: noop(base.withColumn(
            "rn", F.row_number().over(Window.partitionBy("k").orderBy("t", "id"))).filter("rn = 1")),
        "first_per_key": lambda: noop(first_per_key(base, ["k"], ["t", "id"])),
        "window_lead": lambda: noop(base.withColumn(
            "nxt", F.lead("s").over(Window.partitionBy("k").orderBy("t", "id")))),
        "next_in_group": lambda: noop(next_in_group(base, ["k"], ["t", "id"], ["s"])),
        "global_rank": lambda: noop(global_rank(base, ["k", "t", "id"])),
    }
    for name, run in runs.items():
        sc.setJobGroup(name, name)
        run()
    app_id = sc.applicationId
    spark.stop()

    stage_group, task_reads = {}, defaultdict(list)
    for path in sorted(glob.glob(os.path.join(logdir, "**", "*"), recursive=True)):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path, encoding="utf-8") as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    read = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    task_reads[ev["Stage ID"]].append(read)
    report, stages = {}, defaultdict(list)
    for sid, reads in task_reads.items():
        group = stage_group.get(sid)
        total = sum(reads)
        if group is None or total == 0:
            continue
        stage = {"stage": sid, "records": total, "max_task": max(reads), "tasks": len(reads),
                 "tasks_with_rows": sum(r > 0 for r in reads), "max_share": round(max(reads) / total, 3)}
        stages[group].append(stage)
        best = report.get(group)
        if best is None or (total, stage["max_share"]) > (best["records"], best["max_share"]):
            report[group] = stage
    print(json.dumps({"app": app_id, "rows": rows, "partitions": parts, "hot_key_share": 0.333,
                      "eventlog": logdir, "largest_shuffle_stage": report, "shuffle_stages": stages}, ensure_ascii=False, indent=1))


if __name__ == "__main__":
    main()
