"""Shuffle volume per registered query, from Spark's event log.

usage: python tools/shuffle_report.py [SF_DIR] [name-substring ...]

Each query runs once (noop sink) under its own job group; the event log
is written to a fresh scratch folder and the task-end events are summed
per query: shuffle bytes written, shuffle records written, and task
count.  Prints one JSON object per line.
"""
import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fieldlens.registry import QUERIES  # noqa: E402
from fieldlens.session import get_session  # noqa: E402


def main():
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    pats = args
    log_dir = tempfile.mkdtemp(prefix="fieldlens-eventlog-")
    spark = get_session("local[8]", app="fieldlens-shuffle", shuffle_partitions=8,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
                               "spark.ui.showConsoleProgress": "false"})
    sc = spark.sparkContext
    names = [n for n in QUERIES if not pats or any(p in n for p in pats)]
    for name in names:
        sc.setJobGroup(name, name)
        QUERIES[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_query, totals = {}, {n: {"shuffle_bytes": 0, "shuffle_records": 0, "tasks": 0} for n in names}
    files = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p))
    for path in files:
        if path.endswith((".inprogress.crc", ".crc")) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_query[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    q = stage_query.get(ev.get("Stage ID"))
                    if q not in totals:
                        continue
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    totals[q]["shuffle_bytes"] += m.get("Shuffle Bytes Written", 0)
                    totals[q]["shuffle_records"] += m.get("Shuffle Records Written", 0)
                    totals[q]["tasks"] += 1
    for n in names:
        print(json.dumps({"query": n, **totals[n]}))


if __name__ == "__main__":
    main()
