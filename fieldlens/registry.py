"""Registered queries: each pipeline run on the derived test tables, plus
the equivalent DuckDB SQL used as an independent oracle.

``QUERIES[name] = (build(spark, sf_dir) -> DataFrame, oracle_sql | None)``.
Oracle SQL states what each pipeline returns in its own way: P1 from one count
per severity, P5 from counts looked up per cell, P6 and P7 from the hires and
people that each term finds, P8 and P12 from unpivoted (row, column, value)
facts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions.dates import day_list, month_to_yesterday
from .session import scratch_path
from .sinks import documents, outcomes
from .sinks.tables import KeyedTable
from .sources.fixtures import Fixtures, duckdb_with

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, fixtures: tuple[str, ...] = (), sql: str | None = None):
    def deco(fn):
        oracle = None
        if sql is not None:
            body = sql.strip()
            # a body starting with "," continues the fixtures' WITH clause
            oracle = (duckdb_with(fixtures).rstrip() + "\n" + body) if body.startswith(",") \
                else duckdb_with(fixtures) + body
        QUERIES[name] = (lambda spark, sf_dir: fn(Fixtures(spark, sf_dir)), oracle)
        return fn
    return deco


# ---------------------------------------------------------------- parameters
AS_OF = dt.date(1998, 6, 20)
TREND_START, TREND_END = dt.date(1998, 1, 1), dt.date(1998, 3, 31)
GRID_START, GRID_END = dt.date(1998, 1, 1), dt.date(1998, 1, 31)
FIELD = "comm_rack_inspection_date"
RECENT_AS_OF = dt.datetime(2024, 1, 20)


def _d(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


# ---------------------------------------------------------------- severity
from .plans import running, severity as sev  # noqa: E402

def _p1_sql(as_of, extra=()):
    # exact severities first, folded to the labels 1 to 5 and 5+ afterwards
    start, end = month_to_yesterday(as_of)
    keys = ", ".join([*sev.STAFF_KEYS, *extra])
    return f"""
SELECT {keys}, closed_day, label AS bucket, sum(n)::BIGINT AS "count"
FROM (SELECT siebel_id AS emp_id, date_trunc('day', closed_date)::DATE AS closed_day, severity, count(*) AS n
      FROM siebel_srs WHERE closed_date >= TIMESTAMP '{start} 00:00:00' AND closed_date < TIMESTAMP '{end} 00:00:00' + INTERVAL 1 DAY
      GROUP BY ALL)
LEFT JOIN (SELECT unnest(range(-100, 101))::INT AS severity, unnest([if(x > 5, '5+', x::VARCHAR) FOR x IN range(-100, 101)]) AS label)
  USING (severity)
JOIN (SELECT emp_id, {keys} FROM staff_master) USING (emp_id)
GROUP BY ALL"""


@register("p1_severity_summary", ("siebel_srs", "staff_master"), _p1_sql(AS_OF))
def q_p1(fx):
    return sev.severity_summary(fx["siebel_srs"], fx.dim("staff_master"), AS_OF)


def _p2_sql(as_of):
    start, end = month_to_yesterday(as_of)
    cols = "".join(f""",\n  max(t.txt) FILTER (WHERE t.day = {_d(d)}) AS "{d.isoformat()}\"""" for d in day_list(start, end))
    return f"""
, closed AS (SELECT siebel_id, closed_date::DATE AS day, if(severity > 5, '5+', severity::VARCHAR) AS sev
             FROM siebel_srs WHERE closed_date::DATE >= {_d(start)} AND closed_date::DATE <= {_d(end)}),
per_sev AS (SELECT siebel_id, day, sev, count(*) AS n FROM closed GROUP BY ALL),
t AS (SELECT siebel_id, day, sum(n) AS total,
             string_agg(n::VARCHAR || ' P' || sev, ', ' ORDER BY sev) FILTER (WHERE sev IS NOT NULL) AS txt
      FROM per_sev GROUP BY ALL)
SELECT st.tech_id, st.first_name, st.state, st.city, st.zone, st.team, sum(t.total)::BIGINT AS "Total SRs"{cols}
FROM staff_master st JOIN t ON t.siebel_id = st.emp_id
GROUP BY st.emp_id, st.tech_id, st.first_name, st.state, st.city, st.zone, st.team"""


@register("p2_severity_pivot", ("siebel_srs", "staff_master"), _p2_sql(AS_OF))
def q_p2(fx):
    return sev.severity_pivot(fx["siebel_srs"], fx.dim("staff_master"), AS_OF)


@register("p3_pivot_json_rows", ("siebel_srs", "staff_master"),
          _p2_sql(AS_OF).replace("\nSELECT st.tech_id", ",\npiv AS (SELECT st.tech_id", 1)
          + ")\nSELECT to_json(piv) AS json FROM piv")
def q_p3(fx):
    return sev.to_json_rows(sev.severity_pivot(fx["siebel_srs"], fx.dim("staff_master"), AS_OF))


@register("p3_json_document", ("siebel_srs", "staff_master"),
          _p2_sql(AS_OF).replace("\nSELECT st.tech_id", ",\npiv AS (SELECT st.tech_id", 1)
          + ")\nSELECT to_json(piv) AS json FROM piv")
def q_p3_document(fx):
    """The elements of the one JSON array that P3 writes, read back from its parts."""
    path = scratch_path(fx.spark, "severity-pivot")
    documents.write_json_array(sev.severity_pivot(fx["siebel_srs"], fx.dim("staff_master"), AS_OF), path, sev.STAFF_KEYS)
    return documents.read_json_array(fx.spark, path)


def _batches(srs):
    """Three batches (old image, new image) that come to ``srs``: most of it with
    wrong severities, open ends and rows too many; their correction; the rest."""
    first = srs.where("sr_id % 4 <> 0")
    wrong = first.where("sr_id % 3 = 0").withColumns({
        "severity": F.expr("severity % 15 + 1"), "closed_date": F.expr("CASE WHEN sr_id % 2 = 0 THEN closed_date END")})
    extra = srs.where("sr_id % 7 = 0")
    return [(None, first.where("sr_id % 3 <> 0").unionByName(wrong).unionByName(extra)),
            (wrong, first.where("sr_id % 3 = 0")), (extra, srs.where("sr_id % 4 = 0"))]


@register("p1_from_stored_counts", ("siebel_srs", "staff_master"), _p1_sql(AS_OF))
def q_p1_stored(fx):
    path = scratch_path(fx.spark, "closed-counts")
    for k, (old, new) in enumerate(_batches(fx["siebel_srs"])):
        running.add_batch(running.closed_deltas(old, new), path, k)
    return sev.severity_summary(None, fx.dim("staff_master"), AS_OF, counts=running.closed_counts(fx.spark, path, AS_OF))


def _p4_sql(level, am, mgr):
    unit = {"daily": "day", "weekly": "week", "monthly": "month"}.get(level, "day")
    lo, hi = f"TIMESTAMP '{TREND_START} 00:00:00'", f"TIMESTAMP '{TREND_END} 00:00:00'"
    counts = ",".join(f"\n  count(*) FILTER (WHERE severity = {k} AND {side} >= {lo} AND {side} <= {hi}) AS {name}_sev{k}"
                      for side, name in (("open_date", "open"), ("closed_date", "close")) for k in range(1, 16))
    where = [f"((open_date >= {lo} AND open_date <= {hi}) OR (closed_date >= {lo} AND closed_date <= {hi}))"]
    if am is not None:
        where.append(f"assoc_manager_id = {am}")
    if mgr is not None:
        where.append(f"manager_id = {mgr}")
    return f"""
SELECT date_trunc('{unit}', coalesce(open_date, closed_date))::DATE AS aggregation_date,{counts}
FROM siebel_srs WHERE {" AND ".join(where)}
GROUP BY 1"""


for _name, _lvl, _am, _mgr in (("p4_trend_daily", "daily", None, None),
                               ("p4_trend_weekly_assoc2", "weekly", 2, None),
                               ("p4_trend_monthly_both", "monthly", 2, 2),
                               ("p4_trend_invalid_level_mgr2", "hourly", None, 2)):
    def _mk(lvl=_lvl, am=_am, mgr=_mgr):
        return lambda fx: sev.severity_trend(fx["siebel_srs"], TREND_START, TREND_END, am, mgr, lvl)
    register(_name, ("siebel_srs",), _p4_sql(_lvl, _am, _mgr))(_mk())


@register("p4_from_stored_trend", ("siebel_srs",), _p4_sql("weekly", 2, None))
def q_p4_stored(fx):
    path = scratch_path(fx.spark, "trend-counts")
    for k, (old, new) in enumerate(_batches(fx["siebel_srs"])):
        running.add_batch(running.trend_deltas(old, new), path, k)
    return running.severity_trend(fx.spark, path, TREND_START, TREND_END, 2, None, "weekly")


def _p24_sql(as_of):
    start, end = month_to_yesterday(as_of)
    keys = ", ".join(sev.STAFF_KEYS)
    nn = " AND ".join(f"{k} IS NOT NULL" for k in ["manager"] + sev.STAFF_KEYS)
    txt = "CASE WHEN bucket IS NOT NULL THEN CAST(\"count\" AS VARCHAR) || ' P' || bucket END"
    days = ",\n  ".join(f"max(CASE WHEN closed_day = {_d(d)} THEN cell END) AS \"{d.strftime('%b-%d')}\""
                        for d in day_list(start, end))
    return f"""
, s AS ({_p1_sql(as_of, ("assoc_manager_tid", "manager_tid"))}),
r AS (SELECT 'Associate Manager' AS role, assoc_manager_tid AS manager, {keys}, closed_day, bucket, "count" FROM s
      UNION ALL SELECT 'Manager' AS role, manager_tid AS manager, {keys}, closed_day, bucket, "count" FROM s),
d AS (SELECT role, manager, {keys}, closed_day, SUM("count") AS n, string_agg({txt}, ', ' ORDER BY {txt}) AS cell
      FROM r WHERE {nn} GROUP BY role, manager, {keys}, closed_day)
SELECT role, manager, {keys},
  {days},
  CAST(SUM(n) AS BIGINT) AS Total_SRs
FROM d GROUP BY role, manager, {keys}"""


@register("p24_manager_report", ("siebel_srs", "staff_master"), _p24_sql(AS_OF))
def q_p24(fx):
    return sev.manager_report(fx["siebel_srs"], fx.dim("staff_master"), AS_OF)


@register("p24_manager_report_files", ("siebel_srs", "staff_master"), _p24_sql(AS_OF).replace(
    "\nSELECT role, manager,", "\nSELECT if(role = 'Manager', 'MGR_', 'AM_') || replace(manager, ' ', '_') AS report, role, manager,", 1))
def q_p24_files(fx):
    """The report's folders, written and read back."""
    path = scratch_path(fx.spark, "manager-report")
    sev.write_manager_report(sev.manager_report(fx["siebel_srs"], fx.dim("staff_master"), AS_OF), path)
    return fx.spark.read.parquet(path)


# ---------------------------------------------------------------- grid (P5)
from .plans import grid  # noqa: E402


def _sql_str(v):
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def _p5_sql(am, mgr, multiply=True):
    # one looked-up count per cell and kind; a cell's SR counts are multiplied by
    # its activities and the reverse, as a join of both to the cell would
    wanted = [f"assoc_manager_tid = {_sql_str(am)}"] * (am is not None) + [f"manager_tid = {_sql_str(mgr)}"] * (mgr is not None)
    times = lambda other: f" * greatest({other}, 1)" if multiply else ""
    return f"""
, facts AS (
  SELECT 'S' || siebel_id AS who, open_date::DATE AS dy, 'open' AS kind FROM siebel_srs
  UNION ALL SELECT 'S' || siebel_id, closed_date::DATE, 'closed' FROM siebel_srs
  UNION ALL SELECT 'S' || siebel_id, d, 'any sr' FROM (
    SELECT siebel_id, unnest(list_distinct([open_date::DATE, closed_date::DATE])) AS d FROM siebel_srs)
  UNION ALL SELECT 'A' || staff_id, created_at::DATE, record_type FROM project_activities
  UNION ALL SELECT 'A' || staff_id, created_at::DATE, 'any activity' FROM project_activities
    WHERE record_type IN ('Activity', 'Time Task')),
tally AS (SELECT map_from_entries(list(struct_pack(k := concat(who, '/', dy, '/', kind), v := n))) AS m
          FROM (SELECT who, dy, kind, count(*) AS n FROM facts WHERE dy BETWEEN '{GRID_START}' AND '{GRID_END}' GROUP BY ALL)),
looked AS (
  SELECT s.tech_id, s.zone, s.team, s.first_name || ' ' || s.last_name AS full_name, report_date,
    [coalesce(tally.m['S' || s.emp_id || '/' || report_date || '/' || k], 0) FOR k IN ['open', 'closed', 'any sr']] AS sr,
    [coalesce(tally.m['A' || s.id || '/' || report_date || '/' || k], 0) FOR k IN ['Activity', 'Time Task', 'any activity']] AS act
  FROM tally, (SELECT *, unnest(range('{GRID_START}'::DATE, '{GRID_END}'::DATE + 1, INTERVAL 1 DAY))::DATE AS report_date
               FROM staff_master WHERE is_active AND ({" OR ".join(wanted) or "TRUE"})) s)
SELECT report_date, full_name, tech_id, zone, team,
  sum(sr[1]{times("act[3]")})::BIGINT AS open_srs, sum(sr[2]{times("act[3]")})::BIGINT AS closed_srs,
  sum(act[1]{times("sr[3]")})::BIGINT AS activity_count, sum(act[2]{times("sr[3]")})::BIGINT AS time_task_count
FROM looked GROUP BY ALL"""


_GRID_FX = ("staff_master", "siebel_srs", "project_activities")
for _name, _am, _mgr, _mode in (("p5_grid_all", None, None, "multiply"),
                                ("p5_grid_assoc_am1", "AM1", None, "multiply"),
                                ("p5_grid_manager_m2", None, "M2", "multiply"),
                                ("p5_grid_both_managers", "AM1", "M2", "multiply"),
                                ("p5_grid_independent_counts", None, None, "independent")):
    def _mk(am=_am, mgr=_mgr, mode=_mode):
        return lambda fx: grid.daily_staff_summary(fx.dim("staff_master"), fx["siebel_srs"], fx["project_activities"],
                                                   GRID_START, GRID_END, am, mgr, fanout=mode)
    register(_name, _GRID_FX, _p5_sql(_am, _mgr, _mode == "multiply"))(_mk())


# ---------------------------------------------------------------- search
from .plans import search, search_index  # noqa: E402


def _found_sql(terms, hire_cols, keep_hire, keep_manager="TRUE", keep_employee=None):
    """Hires that any term finds, by its own columns or by its employee's name."""
    people = "people AS (SELECT id, concat_ws(' ', coalesce(first_name, ''), coalesce(last_name, '')) AS full_name, " \
             "first_name, last_name FROM employees)"
    if terms:
        list_of = "[" + ", ".join(_sql_str(f"%{t}%") for t in terms) + "]"
        term = f"wanted AS (SELECT unnest({list_of}) AS pattern)"
        found = f"""found AS (
  SELECT h.id FROM wanted JOIN (UNPIVOT (SELECT id, {", ".join(hire_cols)} FROM new_hires) ON {", ".join(hire_cols)} INTO NAME c VALUE v) h
    ON h.v ILIKE pattern
  UNION SELECT h.id FROM wanted
    JOIN (UNPIVOT (SELECT id, first_name, last_name FROM employees) ON first_name, last_name INTO NAME c VALUE v) p ON p.v ILIKE pattern
    JOIN new_hires h ON h.old_emp_id = p.id)"""
    else:
        term, found = "wanted AS (SELECT 1)", "found AS (SELECT id FROM new_hires)"
    if keep_employee:
        found += f", kept AS (SELECT id FROM found WHERE id IN (SELECT h.id FROM new_hires h SEMI JOIN (FROM people WHERE {keep_employee}) p ON h.old_emp_id = p.id))"
    else:
        found += ", kept AS (FROM found)"
    return f"""
, {people},
{term},
{found}
SELECT h.id AS emp_id, coalesce((SELECT full_name FROM people WHERE id = h.old_emp_id), ' ') AS emp_full_name,
       h.manager_id AS emp_manager_id, b.full_name AS manager_name
FROM (FROM people WHERE {keep_manager}) b, (FROM new_hires SEMI JOIN kept USING (id) WHERE {keep_hire}) h
WHERE b.id = h.manager_id"""


def _p6_sql(text, pos=None, join=None, zone=None):
    kept = [f"{col} = {_sql_str(v)}" for col, v in (("req_status", pos), ("hire_status", join), ("zone", zone)) if v is not None]
    return _found_sql(text.split(" ") if text else [], ["req_num"], " AND ".join(kept) or "TRUE")


_SEARCH_FX = ("new_hires", "employees")
for _name, _args in (("p6_search_terms_open", ("1 ann t5", "Open", None, None)),
                     ("p6_search_no_text", (None, None, None, None)),
                     ("p6_search_zone_z1", (None, None, None, "Z1")),
                     ("p6_search_double_space_joined", ("dee  z", None, "Joined", None)),
                     ("p6_search_wildcard_terms", ("#00_1_ l%t3", None, None, "Z2"))):
    def _mk(args=_args):
        return lambda fx: search.search_hires(fx["new_hires"], fx.dim("employees"), *args)
    register(_name, _SEARCH_FX, _p6_sql(*_args))(_mk())


def _p7_sql(text, filters):
    prefix = lambda col, key: f"starts_with({col}, {_sql_str(filters[key])})" if key in filters else None
    hire = f"department = {_sql_str(filters['department'])}" if "department" in filters else "TRUE"
    return _found_sql((text or "").split(), ["name", "position"], hire,
                      prefix("first_name", "manager_first_name") or "TRUE", prefix("last_name", "employee_last_name"))


for _name, _text, _filters in (("p7_spec_search_names", "bob hr", {"employee_last_name": "Last1", "manager_first_name": "Bob"}),
                               ("p7_spec_department", "  cand 1 ", {"department": "HOUSEHOLD"})):
    def _mk(text=_text, filters=_filters):
        return lambda fx: search.search_hires_spec(fx["new_hires"], fx.dim("employees"), text, filters)
    register(_name, _SEARCH_FX, _p7_sql(_text, _filters))(_mk())


@register("p6_search_many", ("search_requests", "new_hires", "employees"), """
, asked AS (SELECT *, unnest(if(coalesce(search_text, '') = '', [NULL], string_split(search_text, ' '))) AS term FROM search_requests),
seen AS (SELECT h.*, first_name, last_name FROM new_hires h LEFT JOIN employees e ON e.id = h.old_emp_id),
found AS (
  SELECT DISTINCT search_id, h.id FROM asked a JOIN seen h ON (pos_status IS NULL OR pos_status = req_status)
    AND (join_status IS NULL OR join_status = hire_status) AND (a.zone IS NULL OR a.zone = h.zone)
  WHERE term IS NULL OR req_num ILIKE '%' || replace(term, chr(92) || '#', '#') || '%' OR first_name ILIKE '%' || replace(term, chr(92) || '#', '#') || '%'
     OR last_name ILIKE '%' || replace(term, chr(92) || '#', '#') || '%')
SELECT search_id, h.id AS emp_id, coalesce(first_name, '') || ' ' || coalesce(last_name, '') AS emp_full_name, h.manager_id AS emp_manager_id,
       (SELECT coalesce(m.first_name, '') || ' ' || coalesce(m.last_name, '') FROM employees m WHERE m.id = h.manager_id) AS manager_name
FROM found JOIN seen h USING (id) WHERE h.manager_id IN (SELECT id FROM employees)""")
def q_p6_many(fx):
    return search_index.search_many(fx["search_requests"], fx["new_hires"], fx["employees"])


# ---------------------------------------------------------------- changes
from .plans import changes  # noqa: E402

CHANGE_TS = dt.datetime(2024, 2, 1, 9, 30, 0)


_P8_SQL = f"""
, old AS (UNPIVOT (SELECT emp_id, zone, team, title FROM staff_master) ON zone, team, title INTO NAME col VALUE was),
new AS (UNPIVOT (SELECT emp_id, zone, team, title FROM staff_staging) ON zone, team, title INTO NAME col VALUE is_now),
changed AS (SELECT DISTINCT emp_id FROM old JOIN new USING (emp_id, col) WHERE was <> is_now),
tracked AS (
  SELECT emp_id, string_agg('"' || col || '":{{"old":' || coalesce(to_json(was)::VARCHAR, 'null') || ',"new":' || coalesce(to_json(is_now)::VARCHAR, 'null') || '}}', ','
                            ORDER BY list_position(['zone', 'team', 'title'], col)) AS body
  FROM (SELECT emp_id, unnest(['zone', 'team', 'title']) AS col FROM changed)
  LEFT JOIN old USING (emp_id, col) LEFT JOIN new USING (emp_id, col) GROUP BY emp_id)
SELECT emp_id, zone, team, title, first_name AS firstname, last_name AS lastname, mobile, TIMESTAMP '{CHANGE_TS}' AS change_date,
       '{{"changes":{{' || body || '}}}}' AS comments
FROM staff_master JOIN tracked USING (emp_id)"""


@register("p8_staff_change_history", ("staff_master", "staff_staging"), _P8_SQL)
def q_p8(fx):
    return changes.staff_change_history(fx["staff_master"], fx["staff_staging"], CHANGE_TS)


@register("p8_change_history_by_digest", ("staff_master", "staff_staging"), _P8_SQL)
def q_p8_digest(fx):
    return changes.staff_change_history_by_digest(fx["staff_master"], fx["staff_staging"], CHANGE_TS)


_MASTER_COLS = ("id emp_id tech_id first_name last_name state city zone team title mobile "
                "assoc_manager_tid manager_tid time_zone is_active").split()
_P9_SET = {"zone": "zone", "team": "team", "title": "title", "first_name": "firstname",
           "last_name": "lastname", "mobile": "mobile"}
_STAGED = ["zone", "team", "title", "firstname", "lastname", "mobile"]


def _p9_sql(staging):
    """Each column's value looked up per key: the staged one where the key is
    staged (the row that is last in descending order of its columns), else the master's."""
    order = ", ".join(f"{c} DESC NULLS LAST" for c in _STAGED)
    facts = "\n  UNION ALL ".join(
        f"SELECT emp_id, '{t}' AS col, {s} AS value FROM (SELECT DISTINCT ON (emp_id) * FROM {staging} ORDER BY emp_id, {order})"
        for t, s in _P9_SET.items())
    cells = ", ".join(f"if(staged.vals IS NULL, {c}, staged.vals['{c}']) AS {c}" if c in _P9_SET else c for c in _MASTER_COLS)
    return f"""
, fact AS ({facts}),
staged AS (SELECT emp_id AS key, map_from_entries(list(struct_pack(k := col, v := value))) AS vals FROM fact GROUP BY emp_id)
SELECT {cells} FROM staged RIGHT JOIN staff_master ON key = emp_id"""


@register("p9_apply_staging", ("staff_master", "staff_staging"), _p9_sql("staff_staging"))
def q_p9(fx):
    return changes.apply_staging(fx["staff_master"], fx["staff_staging"])[0]


@register("p9_apply_staging_repeated", ("staff_master", "staff_staging_repeated"), _p9_sql("staff_staging_repeated"))
def q_p9_repeated(fx):
    return changes.apply_staging(fx["staff_master"], fx["staff_staging_repeated"])[0]


@register("p9_staging_reports", ("staff_staging_repeated",), """
SELECT emp_id, count(*) AS copies FROM staff_staging_repeated GROUP BY emp_id
HAVING count(DISTINCT (zone, team, title, firstname, lastname, mobile)) > 1""")
def q_p9_reports(fx):
    return changes.apply_staging(fx["staff_master"], fx["staff_staging_repeated"])[1]


@register("p9_update_stored_master", ("staff_master", "staff_staging_repeated"), _p9_sql("staff_staging_repeated"))
def q_p9_stored(fx):
    """SELECT INTO, UPDATE ... FROM on the stored table, and what it holds then."""
    master = fx["staff_master"]
    table = KeyedTable(scratch_path(fx.spark, "staff-master"), master.schema, ("emp_id",), parts=16).create(master)
    changes.update_stored_master(table, fx["staff_staging_repeated"])
    return table.rows(fx.spark)


_P10_SQL = """
, ad AS (SELECT van_number, emp_id, start_date, end_date FROM van_allocation_history WHERE is_active = TRUE),
m AS (SELECT DISTINCT vm.l_orderkey, vm.l_linenumber, vm.van_number, vm.mileage_date, vm.miles,
             first_value(ad.emp_id) OVER (PARTITION BY vm.l_orderkey, vm.l_linenumber, vm.van_number, vm.mileage_date, vm.miles
                                ORDER BY ad.start_date DESC, ad.emp_id ASC NULLS LAST) AS new_emp
      FROM van_mileage vm JOIN ad ON vm.van_number = ad.van_number
       AND vm.mileage_date >= ad.start_date AND vm.mileage_date <= ad.end_date)
SELECT vm.l_orderkey, vm.l_linenumber, vm.van_number, vm.mileage_date, vm.miles,
       CASE WHEN m.l_orderkey IS NOT NULL THEN m.new_emp ELSE vm.emp_id END AS emp_id
FROM van_mileage vm LEFT JOIN m ON m.l_orderkey = vm.l_orderkey AND m.l_linenumber = vm.l_linenumber
  AND m.van_number = vm.van_number AND m.mileage_date = vm.mileage_date AND m.miles = vm.miles"""


@register("p10_assign_mileage_by_date_range", ("van_mileage", "van_allocation_history"), _P10_SQL)
def q_p10(fx):
    return changes.assign_by_date_range(fx["van_mileage"], fx["van_allocation_history"])


@register("p10_assign_mileage_open_ends", ("van_mileage", "van_allocation_open"),
          _P10_SQL.replace("van_allocation_history", "van_allocation_open"))
def q_p10_open(fx):
    return changes.assign_by_date_range(fx["van_mileage"], fx["van_allocation_open"])


@register("p10_assign_mileage_by_second", ("van_mileage_seconds", "van_allocation_seconds"), """
, held AS (
  SELECT vm.van_number, mileage_ts, emp_id AS new_emp, start_ts,
         rank() OVER (PARTITION BY vm.van_number, mileage_ts ORDER BY start_ts DESC, emp_id NULLS LAST) AS place
  FROM (SELECT DISTINCT van_number, mileage_ts FROM van_mileage_seconds) vm
  JOIN (FROM van_allocation_seconds WHERE is_active) a ON a.van_number = vm.van_number AND mileage_ts BETWEEN start_ts AND end_ts),
won AS (SELECT DISTINCT van_number AS van, mileage_ts AS at_ts, new_emp FROM held WHERE place = 1)
SELECT * EXCLUDE (van, at_ts, new_emp) REPLACE (if(van IS NULL, emp_id, new_emp) AS emp_id)
FROM van_mileage_seconds LEFT JOIN won ON van = van_number AND at_ts = mileage_ts""")
def q_p10_seconds(fx):
    return changes.assign_by_time_range(fx["van_mileage_seconds"], fx["van_allocation_seconds"], grain=1_000_000)


# ---------------------------------------------------------------- JSON fields
from .plans import jsonfields  # noqa: E402

_P11_SQL = """
, fact AS (UNPIVOT (SELECT site AS row_site, to_json(site) AS site, to_json(p_name) AS p_name, to_json(p_brand) AS p_brand,
                           if(p_size IS NULL, NULL, to_json(p_size)) AS p_size, to_json(p_retailprice) AS p_retailprice FROM project_data)
           ON site, p_name, p_brand, p_size, p_retailprice INTO NAME column_name VALUE json),
element AS (
  SELECT site, wanted.column_name, '{"field_name":' || to_json(field_name) || ',"field_display_name":' || to_json(field_display_name)
         || ',"value":' || coalesce(json::VARCHAR, 'null') || ',"is_track_time":false}' AS body
  FROM fact RIGHT JOIN (SELECT * FROM project_metadata, (SELECT site FROM project_data)) wanted
    ON row_site = site AND fact.column_name = wanted.column_name)
SELECT site, '[' || string_agg(body, ',' ORDER BY wanted_column) || ']' AS field_info
FROM (SELECT site, body, column_name AS wanted_column FROM element) GROUP BY site"""


@register("p11_build_field_json", ("project_data", "project_metadata"), _P11_SQL)
def q_p11(fx):
    return jsonfields.build_field_json(fx["project_data"], fx["project_metadata"])


@register("p12_validate_field_json", ("project_data", "project_metadata"), """
, facts AS (UNPIVOT (SELECT p_partkey_text AS site_text, site, p_name, p_brand, p_size, p_retailprice FROM (
              SELECT site, site::VARCHAR AS p_partkey_text, p_name, p_brand, p_size::VARCHAR AS p_size, p_retailprice::VARCHAR AS p_retailprice
              FROM project_data)) ON p_name, p_brand, p_size, p_retailprice INTO NAME column_name VALUE value),
expected AS (SELECT site, column_name, column_name IN ('site', 'p_name', 'p_brand', 'p_size', 'p_retailprice') AS is_column
             FROM project_data, project_metadata)
SELECT e.site, e.column_name, f.value AS original_value, f.value AS json_value, if(is_column, 'MATCH', 'MISMATCH') AS validation_result
FROM expected e LEFT JOIN facts f USING (site, column_name)""")
def q_p12(fx):
    built = jsonfields.build_field_json(fx["project_data"], fx["project_metadata"], keep_row=True)
    return jsonfields.validate_field_json(built, fx["project_metadata"])


@register("p11_build_field_json_joined", ("project_data", "project_metadata"),
          _P11_SQL)
def q_p11_joined(fx):
    return jsonfields.build_field_json(fx["project_data"], fx["project_metadata"], small_bytes=0)


def _zone_case(col):
    return (f"CASE {col} WHEN 'Eastern' THEN 'America/New_York' WHEN 'Central' THEN 'America/Chicago' "
            f"WHEN 'Mountain' THEN 'America/Denver' WHEN 'Pacific' THEN 'America/Los_Angeles' "
            f"WHEN 'Hawaii' THEN 'Pacific/Honolulu' ELSE 'UTC' END")


def _utc_sql(text, zone_label):
    return f"strftime((CAST({text} AS TIMESTAMP) AT TIME ZONE {_zone_case(zone_label)}) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ')"


def _p13_sql(tbl):
    return f"""
, elems AS (SELECT tech_id, unnest(from_json(project_data, '["JSON"]')) AS el FROM {tbl}),
hits AS (SELECT tech_id, el ->> 'value' AS v FROM elems WHERE el ->> 'field_name' = '{FIELD}')
SELECT h.tech_id, st.time_zone, h.v AS original_value, {_utc_sql("h.v", "st.time_zone")} AS converted_value_utc_iso8601
FROM hits h JOIN staff_master st ON st.tech_id = h.tech_id"""


@register("p13_field_time_to_utc", ("project_execution_json", "staff_master"), _p13_sql("project_execution_json"))
def q_p13(fx):
    return jsonfields.field_time_to_utc(fx["project_execution_json"], fx.dim("staff_master"), FIELD)


def _p14_sql(tbl):
    return f"""
SELECT ped.id, ped.staff_id, ped.tech_id,
  CASE WHEN sm.id IS NOT NULL
        AND len(list_filter(from_json(ped.project_data, '["JSON"]'), lambda e: e ->> 'field_name' = '{FIELD}')) > 0
       THEN to_json(list_transform(from_json(ped.project_data, '["JSON"]'), lambda e:
              CASE WHEN e ->> 'field_name' = '{FIELD}' AND (e ->> 'value') IS NOT NULL
                   THEN json_object('field_name', e ->> 'field_name', 'value', {_utc_sql("e ->> 'value'", "sm.time_zone")})
                   ELSE e END))::VARCHAR
       ELSE ped.project_data END AS project_data
FROM {tbl} ped LEFT JOIN staff_master sm ON ped.staff_id = sm.id"""


@register("p14_rewrite_field_time_to_utc", ("project_execution_json", "staff_master"), _p14_sql("project_execution_json"))
def q_p14(fx):
    return jsonfields.rewrite_field_time_to_utc(fx["project_execution_json"], fx.dim("staff_master"), FIELD)


# ---------------------------------------------------------------- projects
from .plans import projects  # noqa: E402

_NEXT_CYCLE_SQL = """
, c AS (
  SELECT d.*,
    CASE WHEN recurrence = 'one-time' THEN 1 ELSE COALESCE(cycle_index, 0) + 1 END AS next_cycle_index,
    CASE WHEN recurrence = 'one-time' THEN start_date
         ELSE CAST(COALESCE(cycle_end_date, start_date) + INTERVAL '1 day' AS DATE) END AS next_start_date
  FROM project_definition d
  WHERE recurrence IN ('one-time', 'monthly', 'quarterly', 'half-yearly', 'yearly')),
cy AS (
  SELECT c.*,
    CASE recurrence WHEN 'one-time' THEN end_date
      WHEN 'monthly' THEN CAST(next_start_date + INTERVAL '1 month' - INTERVAL '1 day' AS DATE)
      WHEN 'quarterly' THEN CAST(next_start_date + INTERVAL '3 months' - INTERVAL '1 day' AS DATE)
      WHEN 'half-yearly' THEN CAST(next_start_date + INTERVAL '6 months' - INTERVAL '1 day' AS DATE)
      WHEN 'yearly' THEN CAST(next_start_date + INTERVAL '1 year' - INTERVAL '1 day' AS DATE) END AS next_end_date
  FROM c)"""

_GEN_SQL = _NEXT_CYCLE_SQL + """,
g AS (SELECT * FROM cy
      WHERE NOT EXISTS (SELECT 1 FROM project_execution_cycles e
                        WHERE e.project_id = cy.id AND e.cycle_index = cy.next_cycle_index)
        AND scope IN ('Global', 'Zone', 'State', 'Store Type', 'Specified Sites'))"""

_DEF_COLS = ("id recurrence scope scope_data start_date end_date cycle_index cycle_start_date cycle_end_date").split()
_PROJ_FX = ("project_definition", "project_execution_cycles", "site_master")


@register("p15_next_project_cycles", ("project_definition",), _NEXT_CYCLE_SQL + "\nSELECT * FROM cy")
def q_p15(fx):
    return projects.next_project_cycles(fx["project_definition"])[0]


UNTIL = dt.date(2026, 3, 31)


@register("p15_cycles_until", ("project_definition",), f"""
, length(recurrence, months) AS (VALUES ('monthly', 1), ('quarterly', 3), ('half-yearly', 6), ('yearly', 12)),
chain AS (
  WITH RECURSIVE call(id, recurrence, months, cycle_index, cycle_start_date, cycle_end_date) AS (
    SELECT id, d.recurrence, months, coalesce(cycle_index, 0), NULL::DATE, coalesce(cycle_end_date, start_date)
    FROM project_definition d JOIN length l ON l.recurrence = d.recurrence
    UNION ALL
    SELECT id, recurrence, months, cycle_index + 1, (cycle_end_date + INTERVAL 1 DAY)::DATE,
           ((cycle_end_date + INTERVAL 1 DAY)::DATE + to_months(months) - INTERVAL 1 DAY)::DATE
    FROM call WHERE cycle_end_date < {_d(UNTIL)})
  SELECT * EXCLUDE (months) FROM call WHERE cycle_start_date IS NOT NULL)
SELECT * REPLACE (cycle_index::INTEGER AS cycle_index) FROM chain
UNION ALL SELECT id, recurrence, 1, start_date, end_date FROM project_definition
WHERE recurrence = 'one-time' AND start_date <= {_d(UNTIL)}""")
def q_p15_until(fx):
    return projects.cycles_until(fx["project_definition"], UNTIL)[0]


_SKEL_COLS = "g.id AS project_id, {site} AS site, g.next_cycle_index AS cycle_index, g.next_start_date AS cycle_start_date, " \
             "g.next_end_date AS cycle_end_date, TRUE AS is_on_project, 'pending' AS execution_status"


@register("p16_project_skeleton", _PROJ_FX, _GEN_SQL + f"""
SELECT {_SKEL_COLS.format(site='s.site')} FROM g JOIN site_master s ON g.scope = 'Global'
UNION ALL
SELECT {_SKEL_COLS.format(site='s.site')} FROM g JOIN site_master s
  ON g.scope = 'Zone' AND g.scope_data <> '' AND list_contains(string_split(g.scope_data, ','), s.zone)
UNION ALL
SELECT {_SKEL_COLS.format(site='s.site')} FROM g JOIN site_master s
  ON g.scope = 'State' AND g.scope_data <> '' AND list_contains(string_split(g.scope_data, ','), s.state)
UNION ALL
SELECT {_SKEL_COLS.format(site='s.site')} FROM g JOIN site_master s
  ON g.scope = 'Store Type' AND g.scope_data <> '' AND list_contains(string_split(g.scope_data, ','), s.store_type)
UNION ALL
SELECT {_SKEL_COLS.format(site='x.site')}
FROM g, LATERAL (SELECT unnest(CASE WHEN g.scope_data = '' THEN []::VARCHAR[] ELSE string_split(g.scope_data, ',') END) AS site) x
WHERE g.scope = 'Specified Sites'""")
def q_p16(fx):
    return projects.project_skeleton(fx["project_definition"], fx["site_master"], fx["project_execution_cycles"])[0]


@register("p17_advance_definitions", _PROJ_FX, _GEN_SQL + """
SELECT d.id, d.recurrence, d.scope, d.scope_data, d.start_date, d.end_date,
  CASE WHEN g.id IS NOT NULL THEN g.next_cycle_index ELSE d.cycle_index END AS cycle_index,
  CASE WHEN g.id IS NOT NULL THEN g.next_start_date ELSE d.cycle_start_date END AS cycle_start_date,
  CASE WHEN g.id IS NOT NULL THEN g.next_end_date ELSE d.cycle_end_date END AS cycle_end_date
FROM project_definition d LEFT JOIN g ON d.id = g.id""")
def q_p17(fx):
    return projects.advance_definitions(fx["project_definition"], fx["project_execution_cycles"])


# ---------------------------------------------------------------- jobs
from .plans import jobs  # noqa: E402

_UNIT_SECS_SQL = "epoch(CAST('1 ' || m.interval_unit AS INTERVAL))"
_SLOTS_SQL = f"""
, s0 AS (
  SELECT r.*, m.id AS job_id, m.created_at, m.interval_value, m.interval_unit,
    CAST(floor(epoch(r.started_at - m.created_at) / (m.interval_value * {_UNIT_SECS_SQL})) AS BIGINT) + 1 AS run_count
  FROM job_events r JOIN fts_job_master m ON r.name = m.name),
slots AS (
  SELECT CAST(job_id AS VARCHAR) || ':' || CAST(event_seq AS VARCHAR) AS log_id, job_id, name, event_seq, run_count,
    created_at + (run_count - 1) * CAST(CAST(interval_value AS VARCHAR) || ' ' || interval_unit AS INTERVAL) AS scheduled_for,
    'RUNNING' AS status, started_at,
    created_at + run_count * CAST(CAST(interval_value AS VARCHAR) || ' ' || interval_unit AS INTERVAL) AS next_run_at,
    ended_at, status AS end_status, error_message
  FROM s0)"""
_JOB_FX = ("job_events", "fts_job_master")


@register("p18_job_slots", _JOB_FX, _SLOTS_SQL + """
SELECT log_id, job_id, name, event_seq, run_count, scheduled_for, status, started_at, next_run_at FROM slots""")
def q_p18(fx):
    return jobs.job_slots(fx["job_events"], fx.dim("fts_job_master"))[0]


@register("p19_job_log_post_image", _JOB_FX, _SLOTS_SQL + """
SELECT log_id, job_id, scheduled_for, CASE WHEN ended_at IS NOT NULL THEN end_status ELSE status END AS status,
  started_at, ended_at, error_message FROM slots""")
def q_p19_log(fx):
    return jobs.apply_job_events(fx["job_events"], fx.dim("fts_job_master"))[0]


@register("p19_job_master_post_image", _JOB_FX, _SLOTS_SQL + """,
ev AS (SELECT job_id, started_at AS ts, event_seq, 0 AS kind, 'RUNNING' AS ev_status, next_run_at FROM slots
       UNION ALL
       SELECT job_id, ended_at AS ts, event_seq, 1 AS kind, end_status AS ev_status, NULL AS next_run_at
       FROM slots WHERE ended_at IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY job_id, kind ORDER BY ts DESC, event_seq DESC) AS rn_kind,
             row_number() OVER (PARTITION BY job_id ORDER BY ts DESC, event_seq DESC, kind DESC) AS rn_all,
             row_number() OVER (PARTITION BY job_id, kind, ev_status ORDER BY ts DESC, event_seq DESC) AS rn_status
      FROM ev)
SELECT m.id, m.name, m.created_at, m.interval_value, m.interval_unit,
  (SELECT ts FROM r WHERE r.job_id = m.id AND kind = 0 AND rn_kind = 1) AS last_run_start_at,
  (SELECT ts FROM r WHERE r.job_id = m.id AND kind = 1 AND rn_kind = 1) AS last_run_end_at,
  (SELECT ev_status FROM r WHERE r.job_id = m.id AND rn_all = 1) AS last_run_status,
  (SELECT ts FROM r WHERE r.job_id = m.id AND kind = 1 AND ev_status = 'SUCCESS' AND rn_status = 1) AS last_successful_at,
  (SELECT next_run_at FROM r WHERE r.job_id = m.id AND kind = 0 AND rn_kind = 1) AS next_run_at
FROM fts_job_master m""")
def q_p19_master(fx):
    return jobs.apply_job_events(fx["job_events"], fx.dim("fts_job_master"))[1]


_SPELLED = ("CASE trim(lower(m.interval_unit)) WHEN 'mins' THEN 'minute' WHEN 'hrs' THEN 'hour' WHEN 'd' THEN 'day' "
            "WHEN 'mon' THEN 'month' END")


@register("p18_job_slots_spellings", ("job_events", "fts_job_master_spellings"),
          _SLOTS_SQL.replace("m.created_at, m.interval_value, m.interval_unit", f"m.created_at, m.interval_value, {_SPELLED} AS interval_unit")
          .replace("'1 ' || m.interval_unit", f"'1 ' || {_SPELLED}")
          .replace("JOIN fts_job_master m ON r.name = m.name", f"JOIN fts_job_master_spellings m ON r.name = m.name AND {_SPELLED} IS NOT NULL")
          + "\nSELECT log_id, job_id, name, event_seq, run_count, scheduled_for, status, started_at, next_run_at FROM slots")
def q_p18_spellings(fx):
    return jobs.job_slots(fx["job_events"], fx.dim("fts_job_master_spellings"))[0]


_SPELLED_SLOTS = (
    _SLOTS_SQL.replace("m.created_at, m.interval_value, m.interval_unit", f"m.created_at, m.interval_value, {_SPELLED} AS interval_unit")
    .replace("'1 ' || m.interval_unit", f"'1 ' || {_SPELLED}")
    .replace("JOIN fts_job_master m ON r.name = m.name", f"JOIN fts_job_master_spellings m ON r.name = m.name AND {_SPELLED} IS NOT NULL"))


@register("p18_run_outcomes", ("job_events", "fts_job_master_spellings"), _SPELLED_SLOTS + """
SELECT event_seq, name, started_at, log_id, run_count, scheduled_for, next_run_at, NULL AS reason FROM slots
UNION ALL
SELECT event_seq, name, started_at, NULL, NULL, NULL, NULL, 'invalid interval unit: fortnight' FROM job_events WHERE name = 'signup'""")
def q_p18_outcomes(fx):
    """Accepted and rejected runs, written in one pass and read back from their folders."""
    cols = ["event_seq", "name", "started_at", "log_id", "run_count", "scheduled_for", "next_run_at", "reason"]
    every = jobs.run_outcomes(fx["job_events"], fx.dim("fts_job_master_spellings"))
    every = every.select(*cols[:3], *[F.when(F.col("reason").isNull(), F.col(c)).alias(c) for c in cols[3:-1]], "reason")
    path = scratch_path(fx.spark, "run-outcomes")
    counts = outcomes.write_outcomes(every, path)
    good, bad = (outcomes.read_outcomes(fx.spark, path, every, k) for k in counts)
    return good.unionByName(bad)


@register("p12_validate_tampered_json", ("project_tampered", "project_metadata"), """
, el AS (SELECT t.*, unnest(from_json(field_info, '["JSON"]')) AS e FROM project_tampered t),
claim AS (SELECT site, p_brand, p_size, column_name, e ->> 'value' AS said
          FROM el JOIN project_metadata m ON m.field_name = e ->> 'field_name'),
fact AS (SELECT *, CASE column_name WHEN 'p_brand' THEN p_brand WHEN 'p_size' THEN p_size::VARCHAR END AS own FROM claim)
SELECT site, column_name, own AS original_value, said AS json_value,
       if(column_name <> 'p_nope' AND said IS NOT DISTINCT FROM own, 'MATCH', 'MISMATCH') AS validation_result FROM fact""")
def q_p12_tampered(fx):
    return jsonfields.validate_field_json(fx["project_tampered"], fx["project_metadata"])


@register("p18_job_slot_rejects", ("job_events", "fts_job_master_spellings"), """
SELECT *, 'invalid interval unit: fortnight' AS reason FROM job_events WHERE name = 'signup'""")
def q_p18_rejects(fx):
    return jobs.job_slots(fx["job_events"], fx.dim("fts_job_master_spellings"))[1]


_ENDS_SQL = _SLOTS_SQL + """,
last_end AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY log_id ORDER BY ended_at DESC, status DESC NULLS LAST) AS n
                            FROM job_ends) WHERE n = 1)"""


def _ended(fx):
    log = jobs.job_slots(fx["job_events"], fx.dim("fts_job_master"))[0].selectExpr(
        "log_id", "job_id", "scheduled_for", "status", "started_at", "cast(null as timestamp_ntz) AS ended_at",
        "cast(null as string) AS error_message")
    return jobs.end_job_runs(log, fx.dim("fts_job_master"), fx["job_ends"])


_ENDS_FX = (*_JOB_FX, "job_ends")


@register("p19_end_runs_log", _ENDS_FX, _ENDS_SQL + """
SELECT s.log_id, s.job_id, s.scheduled_for, if(e.log_id IS NULL, s.status, e.status) AS status, s.started_at,
       e.ended_at, e.error_message
FROM slots s LEFT JOIN last_end e USING (log_id)""")
def q_p19_end_log(fx):
    return _ended(fx)[0]


@register("p19_end_runs_master", _ENDS_FX, _ENDS_SQL + """,
done AS (SELECT s.job_id, e.* FROM slots s JOIN last_end e USING (log_id))
SELECT m.id, m.name, m.created_at, m.interval_value, m.interval_unit, NULL::TIMESTAMP AS last_run_start_at,
  (SELECT max(ended_at) FROM done WHERE job_id = m.id) AS last_run_end_at,
  (SELECT status FROM done WHERE job_id = m.id ORDER BY ended_at DESC, log_id DESC LIMIT 1) AS last_run_status,
  (SELECT max(ended_at) FROM done WHERE job_id = m.id AND status = 'SUCCESS') AS last_successful_at,
  NULL::TIMESTAMP AS next_run_at
FROM fts_job_master m""")
def q_p19_end_master(fx):
    return _ended(fx)[1]


@register("p19_end_runs_rejects", _ENDS_FX, """
SELECT log_id, status, ended_at, error_message FROM job_ends WHERE starts_with(log_id, 'none:')""")
def q_p19_end_rejects(fx):
    return _ended(fx)[2]


# ---------------------------------------------------------------- quality
from .plans import quality  # noqa: E402

_CATALOG_FX = ("source_columns", "target_columns")


@register("p20_schema_diff_tables", _CATALOG_FX, """
, st AS (SELECT DISTINCT table_name FROM source_columns),
tt AS (SELECT DISTINCT table_name FROM target_columns)
SELECT 'Added Tables' AS "Change Type", table_name AS "Table Name", 'N/A' AS "Details"
FROM st WHERE table_name NOT IN (SELECT table_name FROM tt)
UNION ALL
SELECT 'Removed Tables', table_name, 'N/A' FROM tt WHERE table_name NOT IN (SELECT table_name FROM st)""")
def q_p20(fx):
    return quality.schema_diff_tables(fx["source_columns"], fx["target_columns"])


_S_TYPE = ("s.data_type || CASE WHEN coalesce(s.max_length, 0) <> 0 "
           "THEN '(' || CAST(s.max_length AS VARCHAR) || ')' ELSE '' END")
_P21_SQL = f"""
, s AS (SELECT * FROM source_columns WHERE table_name IN (SELECT table_name FROM target_columns)),
t AS (SELECT * FROM target_columns WHERE table_name IN (SELECT table_name FROM source_columns)),
added AS (
  SELECT s.table_name AS "table", s.column_name AS "column", 'added' AS change,
    s.data_type AS source_data_type, '' AS target_data_type, s.is_nullable AS source_is_nullable, '' AS target_is_nullable,
    CAST(s.max_length AS VARCHAR) AS source_max_length, '' AS target_max_length,
    s.column_default AS source_default, '' AS target_default,
    'ALTER TABLE public.' || s.table_name || ' ADD COLUMN ' || s.column_name || ' ' || {_S_TYPE} ||
      CASE WHEN lower(s.is_nullable) = 'no' THEN ' NOT NULL' ELSE ' NULL' END ||
      CASE WHEN coalesce(s.column_default, '') <> '' THEN ' DEFAULT ' || s.column_default ELSE '' END || ';' AS sql_query
  FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.table_name = s.table_name AND t.column_name = s.column_name)),
removed AS (
  SELECT t.table_name, t.column_name, 'removed', '', t.data_type, '', t.is_nullable, '', CAST(t.max_length AS VARCHAR),
    '', t.column_default, 'ALTER TABLE public.' || t.table_name || ' DROP COLUMN ' || t.column_name || ';'
  FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.table_name = t.table_name AND s.column_name = t.column_name)),
modified AS (
  SELECT s.table_name, s.column_name, 'modified', s.data_type, t.data_type, s.is_nullable, t.is_nullable,
    CAST(s.max_length AS VARCHAR), CAST(t.max_length AS VARCHAR), s.column_default, t.column_default,
    'ALTER TABLE public.' || s.table_name || ' ' || array_to_string(list_filter([
       CASE WHEN s.data_type IS DISTINCT FROM t.data_type OR s.max_length IS DISTINCT FROM t.max_length
            THEN 'ALTER COLUMN ' || s.column_name || ' TYPE ' || {_S_TYPE} END,
       CASE WHEN s.is_nullable IS DISTINCT FROM t.is_nullable
            THEN 'ALTER COLUMN ' || s.column_name || CASE WHEN lower(s.is_nullable) = 'no' THEN ' SET NOT NULL' ELSE ' DROP NOT NULL' END END,
       CASE WHEN s.column_default IS DISTINCT FROM t.column_default
            THEN 'ALTER COLUMN ' || s.column_name || CASE WHEN s.column_default IS NOT NULL THEN ' SET DEFAULT ' || s.column_default ELSE ' DROP DEFAULT' END END
    ], lambda x: x IS NOT NULL), ', ') || ';'
  FROM s JOIN t ON s.table_name = t.table_name AND s.column_name = t.column_name
  WHERE s.data_type IS DISTINCT FROM t.data_type OR s.is_nullable IS DISTINCT FROM t.is_nullable
     OR s.max_length IS DISTINCT FROM t.max_length OR s.column_default IS DISTINCT FROM t.column_default),
p21 AS (SELECT * FROM added UNION ALL SELECT * FROM removed UNION ALL SELECT * FROM modified)"""


@register("p21_schema_diff_columns", _CATALOG_FX, _P21_SQL + "\nSELECT * FROM p21")
def q_p21(fx):
    return quality.schema_diff_columns(fx["source_columns"], fx["target_columns"])


def _p22_sql(source, pairs, nulls):
    flags = []
    per_col: dict[str, list[str]] = {}
    for a, b in pairs:
        name = f"diff_{a}__{b}"
        flags.append((f"NOT coalesce({a} = {b}, false)" if nulls == "differ" else f"{a} IS DISTINCT FROM {b}") + f" AS {name}")
        for c in (a, b):
            per_col.setdefault(c, []).append(name)
    hl = [" OR ".join(v) + f" AS highlight_{c}" for c, v in per_col.items()]
    return f"SELECT *, {', '.join(hl)} FROM (SELECT *, {', '.join(flags)} FROM {source}) f"


@register("p22_datatype_sheet_flags", ("datatype_sheet",), _p22_sql("datatype_sheet", quality.DATATYPE_SHEET_PAIRS, "differ"))
def q_p22(fx):
    return quality.pair_diff_flags(fx["datatype_sheet"], quality.DATATYPE_SHEET_PAIRS, nulls="differ")


@register("p22_schema_diff_flags", _CATALOG_FX, _P21_SQL + "\n" + _p22_sql("p21", quality.SCHEMA_DIFF_PAIRS, "equal"))
def q_p22_schema(fx):
    d = quality.schema_diff_columns(fx["source_columns"], fx["target_columns"])
    return quality.pair_diff_flags(d, quality.SCHEMA_DIFF_PAIRS, nulls="equal")


_CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
for _n in (17, 30):
    register(f"p23_long_values_customer_{_n}", (),
             "SELECT " + ", ".join(f"CASE WHEN length(CAST({c} AS VARCHAR)) > {_n} THEN {c} END AS {c}"
                                   for c in _CUSTOMER_COLS) + " FROM customer")(
        (lambda n: lambda fx: quality.long_values(fx["customer"], n))(_n))


@register("p23_long_value_findings_part", (), """
SELECT p_partkey, column_name, value FROM (
  SELECT p_partkey, 'p_name' AS column_name, p_name AS value FROM part
  UNION ALL SELECT p_partkey, 'p_brand', p_brand FROM part
  UNION ALL SELECT p_partkey, 'p_type', p_type FROM part
  UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part
  UNION ALL SELECT p_partkey, 'p_retailprice', CAST(p_retailprice AS VARCHAR) FROM part) u
WHERE length(value) > 9""")
def q_p23_findings(fx):
    return quality.long_value_findings(fx["part"], ["p_partkey"], 9)


@register("p25_recent_events", (), f"""
SELECT * FROM events WHERE ts >= TIMESTAMP '{RECENT_AS_OF}' - INTERVAL 7 DAY""")
def q_p25(fx):
    return quality.recent_rows(fx["events"], "ts", RECENT_AS_OF, days=7)


# ---------------------------------------------------------------- mail
from .plans import mail  # noqa: E402


@register("p26_sorted_recipients", ("recipients",), """
, r AS (SELECT *, CASE WHEN instr(name, ',') > 0 THEN trim(split_part(name, ',', 1), ' ')
                       WHEN len(string_split(name, ' ')) >= 2 THEN trim(string_split(name, ' ')[-1], ' ')
                       ELSE name END AS ln
        FROM recipients)
SELECT message_id, type, COUNT(*) AS recipient_count, COUNT(*) > 1 AND type <> 'Bcc' AS reordered,
       string_agg(address, '; ' ORDER BY CASE WHEN type <> 'Bcc' THEN ln END, position) AS sorted_addresses
FROM r GROUP BY message_id, type""")
def q_p26(fx):
    return mail.sorted_recipients(fx["recipients"])


# ---------------------------------------------------------------- reject paths and whole-text scans
@register("p16_project_rejects", _PROJ_FX, _NEXT_CYCLE_SQL + """,
bad_scope AS (SELECT * FROM cy
              WHERE NOT EXISTS (SELECT 1 FROM project_execution_cycles e
                                WHERE e.project_id = cy.id AND e.cycle_index = cy.next_cycle_index)
                AND (scope IS NULL OR scope NOT IN ('Global', 'Zone', 'State', 'Store Type', 'Specified Sites')))
SELECT id, recurrence, 'invalid recurrence' AS reason FROM project_definition
WHERE recurrence IS NULL OR recurrence NOT IN ('one-time', 'monthly', 'quarterly', 'half-yearly', 'yearly')
UNION ALL
SELECT id, recurrence, 'invalid scope' AS reason FROM bad_scope""")
def q_p16_rejects(fx):
    return projects.project_skeleton(fx["project_definition"], fx.dim("site_master"), fx["project_execution_cycles"])[1]


_DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]


@register("p23_long_values_documents", (), "SELECT " + ", ".join(
    f"CASE WHEN length(CAST({c} AS VARCHAR)) > 30 THEN {c} END AS {c}" for c in _DOC_COLS) + " FROM documents")
def q_p23_documents(fx):
    return quality.long_values(fx["documents"], 30)


@register("p23_long_value_findings_conversations", (), """
SELECT conv_id, turn, column_name, value FROM (
  SELECT conv_id, turn, 'role' AS column_name, role AS value FROM conversations
  UNION ALL SELECT conv_id, turn, 'text', text FROM conversations) u
WHERE length(value) > 30""")
def q_p23_conversations(fx):
    return quality.long_value_findings(fx["conversations"], ["conv_id", "turn"], 30)


# ---------------------------------------------------------------- P13/P14 across daylight-saving changes
for _suffix in ("spring", "fall"):
    _tbl = f"project_execution_json_{_suffix}"

    def _mk13(tbl=_tbl):
        return lambda fx: jsonfields.field_time_to_utc(fx[tbl], fx.dim("staff_master"), FIELD)

    def _mk14(tbl=_tbl):
        return lambda fx: jsonfields.rewrite_field_time_to_utc(fx[tbl], fx.dim("staff_master"), FIELD)

    register(f"p13_field_time_to_utc_dst_{_suffix}", (_tbl, "staff_master"), _p13_sql(_tbl))(_mk13())
    register(f"p14_rewrite_field_time_to_utc_dst_{_suffix}", (_tbl, "staff_master"), _p14_sql(_tbl))(_mk14())


# ---------------------------------------------------------------- P18 with calendar units on a month end
@register("p18_job_slots_calendar", ("job_events", "fts_job_master_calendar"),
          _SLOTS_SQL.replace("JOIN fts_job_master m", "JOIN fts_job_master_calendar m") + """
SELECT log_id, job_id, name, event_seq, run_count, scheduled_for, status, started_at, next_run_at FROM slots""")
def q_p18_calendar(fx):
    return jobs.job_slots(fx["job_events"], fx.dim("fts_job_master_calendar"))[0]


# ---------------------------------------------------------------- the reference's SQL call surface
from .sql_functions import register_sql_functions  # noqa: E402


def _sql_call(views: tuple[str, ...], statement: str):
    def build(fx):
        register_sql_functions(fx.spark, {v: fx[v] for v in views})
        return fx.spark.sql(statement)
    return build


register("p1_sql_get_severity_summary", ("siebel_srs", "staff_master"), _p1_sql(AS_OF))(
    _sql_call(("siebel_srs", "staff_master"), f"SELECT * FROM get_severity_summary(DATE'{AS_OF}')"))
register("p4_sql_get_severity_counts", ("siebel_srs",), _p4_sql("weekly", 2, None))(
    _sql_call(("siebel_srs",), f"SELECT * FROM GetSeverityCounts(DATE'{TREND_START}', DATE'{TREND_END}', 2, NULL, 'weekly')"))
register("p5_sql_get_daily_summary", _GRID_FX, _p5_sql(None, "M2"))(
    _sql_call(("siebel_srs", "staff_master", "project_activities"),
              f"SELECT * FROM get_daily_summary(DATE'{GRID_START}', DATE'{GRID_END}', manager_tid => 'M2')"))
register("p6_sql_search_all_emp", _SEARCH_FX, _p6_sql("1 ann t5", "Open"))(
    _sql_call(("new_hires", "employees"), "SELECT * FROM search_all_emp('1 ann t5', 'Open')"))


# ---------------------------------------------------------------- more parameter paths
@register("p22_datatype_sheet_flags_nulls_equal", ("datatype_sheet",),
          _p22_sql("datatype_sheet", quality.DATATYPE_SHEET_PAIRS, "equal"))
def q_p22_equal(fx):
    return quality.pair_diff_flags(fx["datatype_sheet"], quality.DATATYPE_SHEET_PAIRS, nulls="equal")


@register("p25_recent_events_1_day", (), f"""
SELECT * FROM events WHERE ts >= TIMESTAMP '{RECENT_AS_OF}' - INTERVAL 1 DAY""")
def q_p25_1day(fx):
    return quality.recent_rows(fx["events"], "ts", RECENT_AS_OF, days=1)
register("p3_sql_pivot_severity_summary_json", ("siebel_srs", "staff_master"),
         _p2_sql(AS_OF).replace("\nSELECT st.tech_id", ",\npiv AS (SELECT st.tech_id", 1)
         + ")\nSELECT to_json(piv) AS json FROM piv")(
    _sql_call(("siebel_srs", "staff_master"), f"SELECT * FROM pivot_severity_summary_json(DATE'{AS_OF}')"))
