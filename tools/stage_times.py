"""Stage and task times of one query from Spark's event log (no UI).

Usage: python tools/stage_times.py QUERY [sf_dir]
Runs the query once (noop sink) with the event log written to a fresh
scratch folder, then prints per stage: tasks, wall time, median and max
task time (skew) and shuffle bytes read / written.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    name = sys.argv[1]
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="weekcast-events-")
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").appName(f"stages-{name}")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "16").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from weekcast.queries import QUERIES
    from weekcast.session import shared_dir, ship_package
    shared_dir(spark)
    ship_package(spark)
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    spark.stop()

    tasks, stages = {}, {}
    files = [os.path.join(r, f) for r, _, fs in os.walk(log_dir) for f in fs if not f.startswith(".")]
    for path in sorted(files):  # rolling logs: a folder of event files per application
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerTaskEnd":
                    info, m = ev["Task Info"], ev.get("Task Metrics") or {}
                    rd = (m.get("Shuffle Read Metrics") or {})
                    wr = (m.get("Shuffle Write Metrics") or {})
                    tasks.setdefault(ev["Stage ID"], []).append((
                        info["Finish Time"] - info["Launch Time"],
                        rd.get("Remote Bytes Read", 0) + rd.get("Local Bytes Read", 0),
                        wr.get("Shuffle Bytes Written", 0)))
                elif kind == "SparkListenerStageCompleted":
                    si = ev["Stage Info"]
                    stages[si["Stage ID"]] = (si["Stage Name"].split(" at ")[0],
                                              si.get("Completion Time", 0) - si.get("Submission Time", 0))
    print(f"{'stage':>5} {'tasks':>5} {'wall ms':>8} {'med ms':>7} {'max ms':>7} {'shuf rd KB':>10} "
          f"{'shuf wr KB':>10}  name")
    for sid in sorted(tasks):
        t = tasks[sid]
        dur = [x[0] for x in t]
        nm, wall = stages.get(sid, ("?", 0))
        print(f"{sid:>5} {len(t):>5} {wall:>8} {statistics.median(dur):>7.0f} {max(dur):>7} "
              f"{sum(x[1] for x in t) / 1024:>10.1f} {sum(x[2] for x in t) / 1024:>10.1f}  {nm}")
    print(f"event log: {log_dir}")


if __name__ == "__main__":
    main()
