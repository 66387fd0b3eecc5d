"""P5: dense day x active-staff activity grid.

The reference left-joins SRs and activities to every (day, staff) cell
at once, so a cell with ``s`` SRs and ``a`` activities yields ``s * a``
joined rows and each count is multiplied by the other side's size (its
``open_srs`` counts (SR, activity) pairs).  Here both sides are first
aggregated to one row per (person, day); the cell then reproduces the
same numbers arithmetically (``fanout="multiply"``, the default) or the
plain counts (``fanout="independent"``).  No pair is ever materialised,
so a person with a third of all SRs costs one row per day.

Only sparse cells (staff-days that have SRs or activities) are joined and
aggregated; the dense grid is generated at the very end, per group of
staff attributes, with ``explode(sequence(start, end))`` and a map lookup.
No cross join, and nothing of grid size is ever shuffled.  ``staff.id``
is the staff key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import to_date
from ..functions.text import let, pipe_concat

GROUP_KEYS = ["report_date", "full_name", "tech_id", "zone", "team"]
RECORD_TYPES = ("Activity", "Time Task")


def manager_rule(assoc_manager_tid=None, manager_tid=None):
    """Either given manager matches; none given means everyone."""
    if assoc_manager_tid is None and manager_tid is None:
        return F.lit(True)
    cond = F.lit(False)
    if assoc_manager_tid is not None:
        cond = cond | (F.col("assoc_manager_tid") == F.lit(assoc_manager_tid))
    if manager_tid is not None:
        cond = cond | (F.col("manager_tid") == F.lit(manager_tid))
    return cond


def daily_staff_summary(staff: DataFrame, srs: DataFrame, activities: DataFrame, start, end,
                        assoc_manager_tid: str | None = None, manager_tid: str | None = None,
                        fanout: str = "multiply") -> DataFrame:
    """Per day in [start, end] and active staff (grouped by name, tech_id,
    zone, team): open_srs, closed_srs, activity_count, time_task_count.
    Cells without data are kept with zeros.  ``start > end`` gives no rows.
    """
    if fanout not in ("multiply", "independent"):
        raise ValueError("fanout must be 'multiply' or 'independent'")
    s, e = F.lit(to_date(start)), F.lit(to_date(end))

    staff_f = (staff.where(F.col("is_active") & manager_rule(assoc_manager_tid, manager_tid))
               .select(F.col("id").alias("staff_id"), "emp_id",
                       pipe_concat(F.col("first_name"), " ", F.col("last_name")).alias("full_name"),
                       "tech_id", "zone", "team"))
    od, cd = F.to_date("open_date"), F.to_date("closed_date")
    sr_days = (srs.select("siebel_id", od.alias("od"), cd.alias("cd"))
               .where(F.col("od").between(s, e) | F.col("cd").between(s, e))
               .withColumn("s_day", F.explode(F.array_distinct(F.array("od", "cd"))))
               .where(F.col("s_day").between(s, e))
               .groupBy("siebel_id", "s_day")
               .agg(F.count(F.when(F.col("od") == F.col("s_day"), 1)).alias("n_open"),
                    F.count(F.when(F.col("cd") == F.col("s_day"), 1)).alias("n_closed"),
                    F.count(F.lit(1)).alias("n_sr")))

    act_days = (activities.where(F.col("record_type").isin(*RECORD_TYPES))
                .select(F.col("staff_id").alias("a_staff"), F.to_date("created_at").alias("a_day"), "record_type")
                .where(F.col("a_day").between(s, e))
                .groupBy("a_staff", "a_day")
                .agg(F.count(F.when(F.col("record_type") == "Activity", 1)).alias("n_act"),
                     F.count(F.when(F.col("record_type") == "Time Task", 1)).alias("n_tt"),
                     F.count(F.lit(1)).alias("n_pa")))

    keys = GROUP_KEYS[1:]
    # sparse cells: one row per (staff row, day) that has SRs or activities
    sr_cells = (staff_f.join(sr_days, staff_f["emp_id"] == sr_days["siebel_id"])
                .select("staff_id", *keys, F.col("s_day").alias("day"), "n_open", "n_closed", "n_sr"))
    act_cells = (staff_f.join(act_days, staff_f["staff_id"] == act_days["a_staff"])
                 .select("staff_id", *keys, F.col("a_day").alias("day"), "n_act", "n_tt", "n_pa"))
    counts = ["n_open", "n_closed", "n_sr", "n_act", "n_tt", "n_pa"]
    per_cell = (sr_cells.unionByName(act_cells, allowMissingColumns=True)
                .groupBy("staff_id", *keys, "day")
                .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts]))
    if fanout == "multiply":
        per_sr = F.greatest(F.col("n_pa"), F.lit(1))
        per_pa = F.greatest(F.col("n_sr"), F.lit(1))
    else:
        per_sr = per_pa = F.lit(1)
    per_key_day = (per_cell.groupBy(*keys, "day")
                   .agg(F.sum(F.col("n_open") * per_sr).alias("o"), F.sum(F.col("n_closed") * per_sr).alias("c"),
                        F.sum(F.col("n_act") * per_pa).alias("a"), F.sum(F.col("n_tt") * per_pa).alias("t")))
    # dense output: every key group gets every day; the days are generated
    # last, per group, so no grid-sized data is ever shuffled
    cell = F.struct(F.col("day").alias("d"), F.lit(0).alias("blank"), *[F.col(c).cast("long").alias(c) for c in "ocat"])
    groups = (staff_f.select(*keys, F.lit(None).cast("date").alias("day"),
                             *[F.lit(None).cast("long").alias(c) for c in "ocat"])
              .unionByName(per_key_day)
              .groupBy(*keys)
              .agg(F.array_sort(F.collect_list(F.when(F.col("day").isNotNull(), cell))).alias("cells")))
    # a blank cell for each day goes between the sorted cells and, of two cells
    # of a day, the blank one goes again: no lookup, whatever the number of days
    blank = F.transform(F.sequence(s, e), lambda d: F.struct(
        d.alias("d"), F.lit(1).alias("blank"), *[F.lit(0).cast("long").alias(c) for c in "ocat"]))
    merged = let(F.array_sort(F.concat("cells", blank)), lambda both: F.filter(
        both, lambda x, i: (i == 0) | (F.get(both, i - 1)["d"] != x["d"])))
    out = groups.select(F.explode(F.when(s <= e, merged)).alias("got"), *keys).withColumn("report_date", F.col("got.d"))
    got = F.col("got")

    def z(c):
        return F.coalesce(got[c], F.lit(0)).cast("long")

    return out.select("report_date", *keys, z("o").alias("open_srs"), z("c").alias("closed_srs"),
                      z("a").alias("activity_count"), z("t").alias("time_task_count"))
