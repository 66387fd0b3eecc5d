"""Service-request severity reporting: P1 summary, P2 month pivot, P3 JSON
rows, P4 open/close trend, P24 per-manager report.

Scale notes
-----------
* SR rows are filtered and pre-aggregated to (staff key, day, bucket)
  *before* they meet the staff table.  Partial aggregation runs map-side,
  so a staff member holding a third of all SRs ships one row per task
  and bucket, not a third of the table.
* Day columns come from an explicit value list computed from the
  parameters (no ``distinct`` job, no data-dependent schema).
* Per-day text is built from at most one row per (day, bucket), so the
  per-staff cell arrays are bounded by days x buckets by construction.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_bucket, day_list, month_to_yesterday, ts_literal
from ..functions.text import severity_bucket

STAFF_KEYS = ["tech_id", "first_name", "state", "city", "zone", "team"]
MAX_SEVERITY = 15


def _closed_in(srs: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    closed_day = F.to_date("closed_date")
    # an empty range (the 1st of a month) folds to an empty relation: nothing is read
    in_range = closed_day.between(F.lit(start), F.lit(end)) if start <= end else F.lit(False)
    return (srs.where(in_range)
            .select("siebel_id", closed_day.alias("closed_day"),
                    severity_bucket("severity").alias("bucket")))


def _per_emp_day_bucket(srs: DataFrame, start, end) -> DataFrame:
    return (_closed_in(srs, start, end)
            .groupBy("siebel_id", "closed_day", "bucket")
            .agg(F.count(F.lit(1)).alias("n")))


def closed_counts(srs: DataFrame, as_of) -> DataFrame:
    """SRs closed from the first of ``as_of``'s month to the day before, counted
    per (siebel_id, closed_day, bucket) -- the shared input of P1, P2 and
    P24.  A job producing several of these reports for one month computes
    it once (write it, or ``checkpoint()`` it under ``spark.checkpoint.dir``)
    and passes it as ``counts=``, so the SR table is scanned once."""
    start, end = month_to_yesterday(as_of)
    return _per_emp_day_bucket(srs, start, end)


def _counts(srs: DataFrame | None, as_of, counts: DataFrame | None) -> DataFrame:
    if counts is not None:
        return counts
    if srs is None:
        raise ValueError("pass srs or precomputed counts")
    return closed_counts(srs, as_of)


def severity_summary(srs: DataFrame | None, staff: DataFrame, as_of,
                     extra_staff_cols: tuple[str, ...] = (), counts: DataFrame | None = None) -> DataFrame:
    """Closed SRs per staff attributes x close day x severity bucket,
    from the first of ``as_of``'s month to the day before ``as_of``.

    Output: tech_id, first_name, state, city, zone, team, closed_day,
    bucket, count (+ ``extra_staff_cols`` as grouping columns).
    Staff rows with equal attributes are merged, as in the reference.
    """
    keys = STAFF_KEYS + list(extra_staff_cols)
    agg = _counts(srs, as_of, counts)
    st = staff.select("emp_id", *keys)
    j = agg.join(st, agg["siebel_id"] == st["emp_id"])
    return (j.groupBy(*keys, "closed_day", "bucket")
            .agg(F.sum("n").cast("long").alias("count")))


def _day_cells(days, fmt) -> list[Column]:
    """One text column per day from the sorted ``__cells`` array of
    (d, sort key, text) structs: the day's texts joined with ', ', NULL
    when the day has none."""
    # SQL text: one call to the JVM for each day instead of a dozen
    return [F.expr(f"nullif(array_join(transform(filter(__cells, x -> x.d = DATE'{d.isoformat()}'), x -> x.t), ', '), '')")
            .alias(fmt(d)) for d in days]


def severity_pivot(srs: DataFrame | None, staff: DataFrame, as_of, counts: DataFrame | None = None) -> DataFrame:
    """One row per staff member with an SR closed this month (to
    yesterday): staff attributes, ``Total SRs`` and one text column per
    day (``YYYY-MM-DD``) such as ``97 P1, 170 P5+`` with parts ordered by
    bucket text.  A day without SRs is NULL; NULL-severity SRs count in
    the total but are left out of the day text.

    Two aggregations: per (staff, day, bucket) counts, then per staff the
    total and the (day, bucket, text) cells -- at most days x 16 entries,
    bounded whatever the SR volume.
    """
    start, end = month_to_yesterday(as_of)
    days = day_list(start, end)
    per_bucket = _counts(srs, as_of, counts)
    text = F.concat(F.col("n").cast("string"), F.lit(" P"), F.col("bucket"))
    cell = F.when(F.col("bucket").isNotNull(),
                  F.struct(F.col("closed_day").alias("d"), F.col("bucket").alias("b"), text.alias("t")))
    per_emp = (per_bucket.groupBy("siebel_id")
               .agg(F.sum("n").cast("long").alias("Total SRs"), F.array_sort(F.collect_list(cell)).alias("__cells")))
    st = staff.select("emp_id", *STAFF_KEYS)
    j = st.join(per_emp, st["emp_id"] == per_emp["siebel_id"])
    return j.select(*STAFF_KEYS, "Total SRs", *_day_cells(days, lambda d: d.isoformat()))


def to_json_rows(df: DataFrame, col: str = "json") -> DataFrame:
    """Each row as one JSON object (NULL fields kept as ``null``).

    The reference wraps the whole result in one JSON array; here rows
    stay distributed (JSON lines), which is the same content without
    funnelling the result through one value.
    """
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]),
                               {"ignoreNullFields": "false"}).alias(col))


def severity_trend(srs: DataFrame, start, end, assoc_mgr_id=None, manager_id=None,
                   level: str | None = "daily") -> DataFrame:
    """Per day/week/month bucket of ``coalesce(open, close)``, counts of
    SRs opened and closed in [start, end] by severity 1..15.

    Bounds are compared as timestamps at midnight (an SR closed after
    midnight on ``end`` is outside), and a close is charged to the open
    date's bucket -- both as in the reference.
    """
    lo, hi = ts_literal(start), ts_literal(end)
    open_in = F.col("open_date").between(lo, hi)
    close_in = F.col("close_date").between(lo, hi)
    s = srs
    if "close_date" not in s.columns:
        s = s.withColumnRenamed("closed_date", "close_date")
    cond = open_in | close_in
    if assoc_mgr_id is not None:
        cond = cond & (F.col("assoc_manager_id") == F.lit(assoc_mgr_id))
    if manager_id is not None:
        cond = cond & (F.col("manager_id") == F.lit(manager_id))
    aggs = [F.expr(f"count_if(severity = {k} AND __{side}_in)").alias(f"{side}_sev{k}")
            for side in ("open", "close") for k in range(1, MAX_SEVERITY + 1)]
    bucket = date_bucket(F.coalesce("open_date", "close_date"), level).alias("aggregation_date")
    s = s.where(cond).select("severity", bucket, open_in.alias("__open_in"), close_in.alias("__close_in"))
    return s.groupBy("aggregation_date").agg(*aggs)


ROLES = (("Associate Manager", "assoc_manager_tid"), ("Manager", "manager_tid"))


def manager_report(srs: DataFrame | None, staff: DataFrame, as_of, counts: DataFrame | None = None) -> DataFrame:
    """Per role and manager, staff x day breakdown text plus ``Total_SRs``.

    One row per (role, manager, staff attributes).  Day columns are named
    ``MMM-dd``; a cell joins ``"<count> P<bucket>"`` parts sorted as text.
    Rows with a NULL manager or NULL staff attribute are left out (the
    report groups drop NULL keys); NULL buckets count in ``Total_SRs``
    only.  Write with :func:`write_manager_report` for one folder per
    manager.
    """
    start, end = month_to_yesterday(as_of)
    days = day_list(start, end)
    summary = severity_summary(srs, staff, as_of, extra_staff_cols=tuple(c for _, c in ROLES), counts=counts)
    roles = F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.col(c).alias("manager")) for r, c in ROLES]))
    s = (summary.select(roles.alias("r"), *STAFF_KEYS, "closed_day", "bucket", "count")
         .select("r.role", "r.manager", *STAFF_KEYS, "closed_day", "bucket", "count"))
    not_null = F.col("manager").isNotNull()
    for k in STAFF_KEYS:
        not_null = not_null & F.col(k).isNotNull()
    s = s.where(not_null)
    text = F.concat(F.col("count").cast("string"), F.lit(" P"), F.col("bucket"))
    cell = F.when(F.col("bucket").isNotNull(), F.struct(F.col("closed_day").alias("d"), text.alias("t")))
    per_staff = (s.groupBy("role", "manager", *STAFF_KEYS)
                 .agg(F.array_sort(F.collect_list(cell)).alias("__cells"),
                      F.sum("count").cast("long").alias("Total_SRs")))
    return per_staff.select("role", "manager", *STAFF_KEYS, *_day_cells(days, lambda d: d.strftime("%b-%d")),
                            "Total_SRs")


# Report name prefix per role.
REPORT_PREFIX = {"Associate Manager": "AM_", "Manager": "MGR_"}


def report_name(role: Column, manager: Column) -> Column:
    """``AM_<manager>`` / ``MGR_<manager>`` with spaces as underscores."""
    prefix = F.when(role == "Associate Manager", F.lit(REPORT_PREFIX["Associate Manager"])).otherwise(
        F.lit(REPORT_PREFIX["Manager"]))
    return F.concat(prefix, F.regexp_replace(manager, " ", "_"))


def write_manager_report(report: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """One output folder per report (``report=AM_<manager>`` or
    ``report=MGR_<manager>``), all written by one distributed job; no
    manager's rows are funnelled through a single task."""
    (report.withColumn("report", report_name(F.col("role"), F.col("manager")))
     .write.mode(mode).partitionBy("report").format(fmt).save(path))
