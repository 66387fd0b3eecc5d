"""SQL surface: the reference's table functions as Spark SQL table functions.

Users of the reference call ``SELECT * FROM get_severity_summary()``,
``get_daily_summary(start, end)``, ``GetSeverityCounts(...)``,
``search_all_emp(...)`` and ``pivot_severity_summary_json()``.  The last
returns one JSON document per staff member here (JSON lines, the same
documents as P3) rather than one array value.  :func:`register_sql_functions` binds the domain
tables as temporary views and creates temporary SQL table functions with
the same names, parameters, defaults and output columns, so those
statements run unchanged on Spark (``CURRENT_DATE`` defaults included).

The bodies follow the same plans as the DataFrame pipelines: SR and
activity rows are pre-aggregated before meeting staff, the day grid is
generated last from a per-group map (no cross join), and search terms
are matched with a higher-order ``exists`` over the split text instead
of assembling SQL text.  Catalyst inlines each call into the caller's
plan, so filters and column pruning still reach the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# view name -> role of the DataFrame passed to register_sql_functions
VIEWS = ("siebel_srs", "staff_master", "project_activities", "new_hires", "employees")

_BUCKET = "CASE WHEN severity > 5 THEN '5+' ELSE CAST(severity AS STRING) END"

GET_SEVERITY_SUMMARY = f"""
CREATE OR REPLACE TEMPORARY FUNCTION get_severity_summary(as_of DATE DEFAULT current_date())
RETURNS TABLE (tech_id STRING, first_name STRING, state STRING, city STRING, zone STRING, team STRING,
               closed_day DATE, bucket STRING, `count` BIGINT)
RETURN
SELECT st.tech_id, st.first_name, st.state, st.city, st.zone, st.team, c.closed_day, c.bucket,
       CAST(sum(c.n) AS BIGINT) AS `count`
FROM (SELECT siebel_id, to_date(closed_date) AS closed_day, {_BUCKET} AS bucket, count(1) AS n
      FROM siebel_srs
      WHERE to_date(closed_date) BETWEEN trunc(get_severity_summary.as_of, 'MM')
                                     AND date_sub(get_severity_summary.as_of, 1)
      GROUP BY 1, 2, 3) c
JOIN staff_master st ON st.emp_id = c.siebel_id
GROUP BY st.tech_id, st.first_name, st.state, st.city, st.zone, st.team, c.closed_day, c.bucket
"""


def _severity_counts_ddl() -> str:
    lo, hi = "CAST(p_start_date AS TIMESTAMP_NTZ)", "CAST(p_end_date AS TIMESTAMP_NTZ)"
    out_cols = ", ".join(f"{side}_sev{k} BIGINT" for side in ("open", "close") for k in range(1, 16))
    # parameters are compared in the projection below the aggregate (an
    # aggregate may not mix parameter and column references)
    counts = ",\n  ".join(f"count(CASE WHEN severity = {k} AND {side}_in THEN 1 END) AS {side}_sev{k}"
                          for side in ("open", "close") for k in range(1, 16))
    return f"""
CREATE OR REPLACE TEMPORARY FUNCTION GetSeverityCounts(p_start_date DATE, p_end_date DATE, p_assoc_mgr_id INT,
                                                       p_manager_id INT, p_aggregation_level STRING)
RETURNS TABLE (aggregation_date DATE, {out_cols})
RETURN
SELECT aggregation_date,
  {counts}
FROM (SELECT CAST(date_trunc(CASE p_aggregation_level WHEN 'weekly' THEN 'week' WHEN 'monthly' THEN 'month'
                                                      ELSE 'day' END,
                             coalesce(open_date, closed_date)) AS DATE) AS aggregation_date,
             severity, open_date BETWEEN {lo} AND {hi} AS open_in, closed_date BETWEEN {lo} AND {hi} AS close_in
      FROM siebel_srs
      WHERE (open_date BETWEEN {lo} AND {hi} OR closed_date BETWEEN {lo} AND {hi})
        AND (p_assoc_mgr_id IS NULL OR assoc_manager_id = p_assoc_mgr_id)
        AND (p_manager_id IS NULL OR manager_id = p_manager_id)) x
GROUP BY aggregation_date
"""


GET_DAILY_SUMMARY = """
CREATE OR REPLACE TEMPORARY FUNCTION get_daily_summary(start_date DATE, end_date DATE,
                                                       assoc_manager_tid STRING DEFAULT NULL,
                                                       manager_tid STRING DEFAULT NULL)
RETURNS TABLE (report_date DATE, full_name STRING, tech_id STRING, zone STRING, team STRING,
               open_srs BIGINT, closed_srs BIGINT, activity_count BIGINT, time_task_count BIGINT)
RETURN
WITH staff_f AS (
  SELECT id AS staff_id, emp_id, first_name || ' ' || last_name AS full_name, tech_id, zone, team
  FROM staff_master sm
  WHERE is_active
    AND ((get_daily_summary.assoc_manager_tid IS NULL AND get_daily_summary.manager_tid IS NULL)
         OR sm.assoc_manager_tid = get_daily_summary.assoc_manager_tid
         OR sm.manager_tid = get_daily_summary.manager_tid)),
sr_days AS (
  SELECT siebel_id, d AS day, count(CASE WHEN od = d THEN 1 END) AS n_open,
         count(CASE WHEN cd = d THEN 1 END) AS n_closed, count(1) AS n_sr
  FROM (SELECT siebel_id, to_date(open_date) AS od, to_date(closed_date) AS cd FROM siebel_srs) s
  LATERAL VIEW explode(array_distinct(array(od, cd))) x AS d
  WHERE d BETWEEN start_date AND end_date
  GROUP BY siebel_id, d),
act_days AS (
  SELECT staff_id, to_date(created_at) AS day, count(CASE WHEN record_type = 'Activity' THEN 1 END) AS n_act,
         count(CASE WHEN record_type = 'Time Task' THEN 1 END) AS n_tt, count(1) AS n_pa
  FROM project_activities
  WHERE record_type IN ('Activity', 'Time Task') AND to_date(created_at) BETWEEN start_date AND end_date
  GROUP BY 1, 2),
cells AS (
  SELECT f.staff_id, f.full_name, f.tech_id, f.zone, f.team, r.day, r.n_open, r.n_closed, r.n_sr,
         0L AS n_act, 0L AS n_tt, 0L AS n_pa
  FROM staff_f f JOIN sr_days r ON r.siebel_id = f.emp_id
  UNION ALL
  SELECT f.staff_id, f.full_name, f.tech_id, f.zone, f.team, a.day, 0L, 0L, 0L, a.n_act, a.n_tt, a.n_pa
  FROM staff_f f JOIN act_days a ON a.staff_id = f.staff_id),
per_cell AS (
  SELECT staff_id, full_name, tech_id, zone, team, day, sum(n_open) AS n_open, sum(n_closed) AS n_closed,
         sum(n_sr) AS n_sr, sum(n_act) AS n_act, sum(n_tt) AS n_tt, sum(n_pa) AS n_pa
  FROM cells GROUP BY staff_id, full_name, tech_id, zone, team, day),
per_key_day AS (
  SELECT full_name, tech_id, zone, team, day,
         sum(n_open * greatest(n_pa, 1)) AS o, sum(n_closed * greatest(n_pa, 1)) AS c,
         sum(n_act * greatest(n_sr, 1)) AS a, sum(n_tt * greatest(n_sr, 1)) AS t
  FROM per_cell GROUP BY full_name, tech_id, zone, team, day),
grp AS (
  SELECT full_name, tech_id, zone, team,
         map_from_entries(collect_list(CASE WHEN day IS NOT NULL
                                            THEN struct(day, named_struct('o', o, 'c', c, 'a', a, 't', t)) END)) AS m
  FROM (SELECT full_name, tech_id, zone, team, CAST(NULL AS DATE) AS day, CAST(NULL AS BIGINT) AS o,
               CAST(NULL AS BIGINT) AS c, CAST(NULL AS BIGINT) AS a, CAST(NULL AS BIGINT) AS t FROM staff_f
        UNION ALL SELECT * FROM per_key_day) u
  GROUP BY full_name, tech_id, zone, team)
SELECT d AS report_date, full_name, tech_id, zone, team,
       coalesce(try_element_at(m, d).o, 0L) AS open_srs, coalesce(try_element_at(m, d).c, 0L) AS closed_srs,
       coalesce(try_element_at(m, d).a, 0L) AS activity_count, coalesce(try_element_at(m, d).t, 0L) AS time_task_count
FROM grp LATERAL VIEW explode(CASE WHEN start_date <= end_date THEN sequence(start_date, end_date) END) g AS d
"""

SEARCH_ALL_EMP = r"""
CREATE OR REPLACE TEMPORARY FUNCTION search_all_emp(search_text STRING DEFAULT NULL,
                                                    pos_status_filter STRING DEFAULT NULL,
                                                    join_status_filter STRING DEFAULT NULL,
                                                    zone_filter STRING DEFAULT NULL)
RETURNS TABLE (emp_id BIGINT, emp_full_name STRING, emp_manager_id BIGINT, manager_name STRING)
RETURN
WITH person AS (SELECT id, first_name, last_name, concat_ws(' ', coalesce(first_name, ''), coalesce(last_name, '')) AS full_name
           FROM employees),
open_hires AS (
  SELECT id, req_num, old_emp_id, manager_id FROM new_hires
  WHERE coalesce(req_status = pos_status_filter, pos_status_filter IS NULL)
    AND coalesce(hire_status = join_status_filter, join_status_filter IS NULL)
    AND coalesce(zone = zone_filter, zone_filter IS NULL))
SELECT h.id AS emp_id, coalesce(p.full_name, ' ') AS emp_full_name, h.manager_id AS emp_manager_id, boss.full_name AS manager_name
FROM open_hires h LEFT JOIN person p ON p.id = h.old_emp_id JOIN person boss ON boss.id = h.manager_id
WHERE coalesce(search_text, '') = ''
   -- one ILIKE pattern for each term; a backslash before another character than %, _ and itself is dropped
   OR exists(transform(split(search_text, ' ', -1),
                       t -> regexp_replace(concat('%', t, '%'), '\\\\([^%_\\\\])|(\\\\[%_\\\\])', '$1$2')),
             x -> exists(array(h.req_num, p.first_name, p.last_name), v -> v ILIKE x))
"""


PIVOT_SEVERITY_SUMMARY_JSON = f"""
CREATE OR REPLACE TEMPORARY FUNCTION pivot_severity_summary_json(as_of DATE DEFAULT current_date())
RETURNS TABLE (json STRING)
RETURN
WITH c AS (
  SELECT siebel_id, to_date(closed_date) AS d, {_BUCKET} AS b, count(1) AS n
  FROM siebel_srs
  WHERE to_date(closed_date) BETWEEN trunc(pivot_severity_summary_json.as_of, 'MM')
                                 AND date_sub(pivot_severity_summary_json.as_of, 1)
  GROUP BY 1, 2, 3),
e AS (
  SELECT siebel_id, sum(n) AS total,
         array_sort(collect_list(CASE WHEN b IS NOT NULL THEN struct(d, b, concat(CAST(n AS STRING), ' P', b) AS t) END))
           AS cells
  FROM c GROUP BY siebel_id)
SELECT to_json(map_concat(
         map('tech_id', CAST(st.tech_id AS VARIANT), 'first_name', CAST(st.first_name AS VARIANT),
             'state', CAST(st.state AS VARIANT), 'city', CAST(st.city AS VARIANT), 'zone', CAST(st.zone AS VARIANT),
             'team', CAST(st.team AS VARIANT), 'Total SRs', CAST(e.total AS VARIANT)),
         map_from_entries(transform(
           CASE WHEN trunc(pivot_severity_summary_json.as_of, 'MM') <= date_sub(pivot_severity_summary_json.as_of, 1)
                THEN sequence(trunc(pivot_severity_summary_json.as_of, 'MM'), date_sub(pivot_severity_summary_json.as_of, 1))
                ELSE array() END,
           day -> struct(
           CAST(day AS STRING),
           CAST(CASE WHEN size(filter(e.cells, x -> x.d = day)) > 0
                     THEN array_join(transform(filter(e.cells, x -> x.d = day), x -> x.t), ', ') END AS VARIANT)))))) AS json
FROM staff_master st JOIN e ON e.siebel_id = st.emp_id
"""


#: Views that this module has made and may replace.
_OURS: set[str] = set()


def register_sql_functions(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Bind ``tables`` (keys from :data:`VIEWS`) as temporary views and create
    the table functions whose inputs are all bound.  Returns their names."""
    for name, df in tables.items():
        if name not in VIEWS:
            raise ValueError(f"unknown table {name!r}; expected one of {VIEWS}")
    for name, df in tables.items():
        if name not in _OURS and spark.catalog.tableExists(name):
            raise ValueError(f"a view or table {name!r} exists already; drop it or bind it under another session")
        _OURS.add(name)
        df.createOrReplaceTempView(name)
    have = set(tables)
    created = []
    for fn, needs, ddl in (("get_severity_summary", {"siebel_srs", "staff_master"}, GET_SEVERITY_SUMMARY),
                           ("GetSeverityCounts", {"siebel_srs"}, _severity_counts_ddl()),
                           ("get_daily_summary", {"siebel_srs", "staff_master", "project_activities"}, GET_DAILY_SUMMARY),
                           ("search_all_emp", {"new_hires", "employees"}, SEARCH_ALL_EMP),
                           ("pivot_severity_summary_json", {"siebel_srs", "staff_master"}, PIVOT_SEVERITY_SUMMARY_JSON)):
        if needs <= have:
            spark.sql(ddl)
            created.append(fn)
    return created
