"""Hot-key check: pipelines on inputs where one key holds a third of the rows.

usage: python tools/skew_report.py [SF_DIR]

Derived from the test tables: a third of all SRs go to one staff member,
a third of all activities to one staff id, a third of all mileage rows to
one van.  Each pipeline runs once under its own job group with the event
log in a fresh scratch folder; for every reduce stage the per-task
shuffle read is compared (largest task vs median).  Prints one JSON
object per pipeline: the worst stage's max/median ratio and bytes.
"""
import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from fieldlens.plans import changes, grid, jobs, severity  # noqa: E402
from fieldlens.registry import AS_OF, GRID_END, GRID_START  # noqa: E402
from fieldlens.session import get_session  # noqa: E402
from fieldlens.sources.fixtures import Fixtures  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="fieldlens-skew-")
    spark = get_session("local[8]", app="fieldlens-skew", shuffle_partitions=16,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                               "spark.eventLog.compress": "false", "spark.ui.showConsoleProgress": "false",
                               # keep every reduce partition visible (no coalescing) for the comparison
                               "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    fx = Fixtures(spark, sf_dir)
    hot = F.col("sr_id") % 3 == 0
    srs = fx["siebel_srs"].withColumn("siebel_id", F.when(hot, F.lit("E000001")).otherwise(F.col("siebel_id")))
    acts = fx["project_activities"].withColumn("staff_id", F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("staff_id")))
    mileage = fx["van_mileage"].withColumn("van_number", F.when(F.col("l_orderkey") % 3 == 0, F.lit(7))
                                           .otherwise(F.col("van_number")))
    staff = fx["staff_master"]
    runs = {
        "p1_severity_summary": lambda: severity.severity_summary(srs, staff, AS_OF),
        "p2_severity_pivot": lambda: severity.severity_pivot(srs, staff, AS_OF),
        "p24_manager_report": lambda: severity.manager_report(srs, staff, AS_OF),
        "p5_grid_all": lambda: grid.daily_staff_summary(staff, srs, acts, GRID_START, GRID_END),
        "p10_assign_mileage_by_date_range": lambda: changes.assign_by_date_range(mileage, fx["van_allocation_history"]),
        "p19_job_master_post_image": lambda: jobs.apply_job_events(fx["job_events"], fx["fts_job_master"])[1],
    }
    sc = spark.sparkContext
    for name, build in runs.items():
        sc.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_query, reads = {}, {}
    files = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(p) and "appstatus" not in os.path.basename(p))
    for path in files:
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_query[sid] = group
                elif ev.get("Event") == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    b = m.get("Remote Bytes Read", 0) + m.get("Local Bytes Read", 0)
                    if b:
                        reads.setdefault(ev["Stage ID"], []).append(b)
    for name in runs:
        worst = None
        for sid, bs in reads.items():
            if stage_query.get(sid) != name or len(bs) < 2:
                continue
            med = statistics.median(bs)
            ratio = max(bs) / med if med else float("inf")
            if worst is None or ratio > worst["max_over_median"]:
                worst = {"stage": sid, "tasks": len(bs), "max_bytes": max(bs), "median_bytes": int(med),
                         "max_over_median": round(ratio, 2)}
        print(json.dumps({"query": name, "hot_key_share": "1/3", "worst_reduce_stage": worst}))


if __name__ == "__main__":
    main()
