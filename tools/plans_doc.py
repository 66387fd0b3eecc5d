"""Write PLANS.md: final adaptive plans (operator skeleton) of the heaviest pipelines at sf0.1."""
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from fieldlens.registry import QUERIES  # noqa: E402
from fieldlens.session import get_session  # noqa: E402

NOTES = {
    "p1_severity_summary": "SRs are filtered and counted per (staff, day, bucket) with a partial aggregate before the only "
                           "shuffle of SR data; the staff join is converted to a broadcast from measured sizes.",
    "p2_severity_pivot": "Same per-bucket counts, then one aggregate per staff member gathers its (day, bucket) cells "
                         "(bounded by days x buckets); day columns come from an explicit list.",
    "p5_grid_all": "Only sparse cells are shuffled (SR and activity pre-aggregates joined to the broadcast staff "
                   "dimension); the dense grid is the Generate at the top, after the last exchange.",
    "p10_assign_mileage_by_date_range": "Allocations are expanded to days and reduced to one winner per (van, day); "
                                        "mileage joins on (van, day) with at most one partner.",
    "p16_project_skeleton": "Sites and projects explode into (scope, value) keys, whose pairs are made in cells "
                            "(`join_in_cells`); the listed-sites branch is a plain explode.",
    "p19_job_master_post_image": "Runs join the broadcast job master; per-job state is a max_by aggregate with a "
                                 "partial step, then a broadcast join back to the master.",
    "p21_schema_diff_columns": "The table-presence aggregate is computed once and reused; semi-joins are broadcasts; "
                               "the only large shuffle is the (table, column) full outer join of the two catalogs.",
}
KEEP = re.compile(r"(Exchange|Join|Aggregate|Generate|Union|BroadcastQueryStage|ShuffleQueryStage|Scan parquet|FileScan)")


def main():
    spark = get_session("local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    out = ["# PLANS", "", "Final adaptive physical plans at sf0.1 (`tools/plans_doc.py`), reduced to exchanges, joins,",
           "aggregates, generators and scans. Regenerate after plan changes.", ""]
    for name, note in NOTES.items():
        df = QUERIES[name][0](spark, "/root/testdata/sf0.1")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("+- == Initial Plan ==")[0]
        lines = [re.sub(r"#\d+L?", "", l)[:150] for l in final.splitlines() if KEEP.search(l)]
        out += [f"## {name}", "", note, "", "```", *lines, "```", ""]
    open(os.path.join(ROOT, "PLANS.md"), "w").write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
