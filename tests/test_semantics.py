"""Unit tests on small literal frames: one per semantic rule / defect
"""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldlens.functions.dates import local_to_utc, iso_utc_text, zone_name
from fieldlens.functions.text import last_name, pg_concat, pg_like_text, pg_split, severity_bucket
from fieldlens.plans import changes, grid, jobs, jsonfields, mail, projects, quality, search, severity
from fieldlens.sources.reference_data import state_master

D = dt.date
T = dt.datetime

STAFF_SCHEMA = ("id long, emp_id string, tech_id string, first_name string, last_name string, state string, "
                "city string, zone string, team string, assoc_manager_tid string, manager_tid string, "
                "time_zone string, is_active boolean")
SRS_SCHEMA = ("siebel_id string, severity int, open_date timestamp_ntz, closed_date timestamp_ntz, "
              "assoc_manager_id int, manager_id int")


def staff_row(i, **kw):
    r = dict(id=i, emp_id=f"E{i}", tech_id=f"T{i}", first_name="Ann", last_name=f"L{i}", state="S", city="C",
             zone="Z", team="X", assoc_manager_tid="AM1", manager_tid="M1", time_zone="Eastern", is_active=True)
    r.update(kw)
    return tuple(r[k] for k in ["id", "emp_id", "tech_id", "first_name", "last_name", "state", "city", "zone",
                                "team", "assoc_manager_tid", "manager_tid", "time_zone", "is_active"])


def _key(t):
    return tuple((v is None, str(v)) for v in t)


def rows(df, *cols):
    got = [tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect()]
    return sorted(got, key=_key)


# ------------------------------------------------------------ expressions
def test_severity_bucket_null_5_6(spark):
    df = spark.createDataFrame([(None,), (5,), (6,), (15,)], "s int")
    assert [r[0] for r in df.select(severity_bucket("s")).collect()] == [None, "5", "5+", "5+"]


def test_pg_concat_and_split(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(pg_concat(F.col("a"), " ", F.col("b"))).collect()] == ["a ", " "]
    df = spark.createDataFrame([("",), ("a,,b ",), (None,)], "s string")
    assert [r[0] for r in df.select(pg_split(F.col("s"), ",")).collect()] == [[], ["a", "", "b "], None]


def test_like_escapes():
    assert pg_like_text("50%") == "50%"
    assert pg_like_text(r"a\b") == "ab"
    assert pg_like_text(r"a\%") == r"a\%"
    with pytest.raises(ValueError):
        pg_like_text("abc\\")


def test_last_name_rules(spark):
    names = ["Ann ", "", "Doe, Jane", "Cher", "First Last", "A B C", " Smith , J"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(last_name("n")).collect()] == ["", "", "Doe", "Cher", "Last", "C", "Smith"]


@pytest.mark.parametrize("local,zone,expected", [
    (T(2024, 11, 3, 1, 30), "Eastern", "2024-11-03T06:30:00Z"),   # ambiguous: standard time
    (T(2024, 3, 10, 2, 30), "Eastern", "2024-03-10T07:30:00Z"),   # skipped hour
    (T(2024, 7, 1, 12, 0), "Eastern", "2024-07-01T16:00:00Z"),
    (T(2024, 7, 1, 12, 0), "Hawaii", "2024-07-01T22:00:00Z"),
    (T(2024, 11, 3, 1, 30), "Central", "2024-11-03T07:30:00Z"),
    (T(2024, 7, 1, 12, 0), "Other", "2024-07-01T12:00:00Z"),
    (T(2024, 7, 1, 12, 0), None, "2024-07-01T12:00:00Z"),
])
def test_local_to_utc_dst(spark, local, zone, expected):
    df = spark.createDataFrame([(local, zone)], "t timestamp_ntz, z string")
    out = df.select(iso_utc_text(local_to_utc(F.col("t"), zone_name(F.col("z"))))).first()[0]
    assert out == expected


# ------------------------------------------------------------ severity
def _srs(spark, data):
    return spark.createDataFrame(data, SRS_SCHEMA)


def test_summary_pivot_and_totals_agree(spark):
    staff = spark.createDataFrame([staff_row(1), staff_row(2, tech_id="T1", last_name="L1")], STAFF_SCHEMA)
    c = T(2024, 5, 3, 10)
    srs = _srs(spark, [("E1", 1, c, c, 0, 0), ("E1", 6, c, c, 0, 0), ("E1", 6, c, c, 0, 0),
                       ("E1", None, c, c, 0, 0), ("E2", 10, c, c, 0, 0), ("E1", 2, c, None, 0, 0)])
    summ = severity.severity_summary(srs, staff, D(2024, 5, 20))
    # staff 1 and 2 share every grouping attribute, so they merge (D2); NULL severity is its own bucket
    assert rows(summ, "bucket", "count") == [("1", 1), ("5+", 3), (None, 1)]
    piv = severity.severity_pivot(srs, staff, D(2024, 5, 20))
    cells = sorted((r["Total SRs"], r["2024-05-03"]) for r in piv.collect())
    assert cells == [(1, "1 P5+"), (4, "1 P1, 2 P5+")]
    assert piv.columns[-1] == "2024-05-19" and len(piv.columns) == 6 + 1 + 19


def test_first_of_month_is_empty(spark):
    staff = spark.createDataFrame([staff_row(1)], STAFF_SCHEMA)
    srs = _srs(spark, [("E1", 1, T(2024, 5, 1), T(2024, 5, 1), 0, 0)])
    assert severity.severity_summary(srs, staff, D(2024, 6, 1)).count() == 0
    assert severity.severity_pivot(srs, staff, D(2024, 6, 1)).count() == 0


def test_trend_close_charged_to_open_bucket_and_midnight_bound(spark):
    srs = _srs(spark, [("E1", 3, T(2023, 12, 30), T(2024, 1, 2), 1, 1),   # close in range, open before
                       ("E1", 3, T(2024, 1, 31, 9), None, 1, 1)])          # after midnight of the end day
    out = severity.severity_trend(srs, D(2024, 1, 1), D(2024, 1, 31), level="daily")
    r = out.collect()
    assert len(r) == 1 and r[0]["aggregation_date"] == D(2023, 12, 30)
    assert r[0]["close_sev3"] == 1 and r[0]["open_sev3"] == 0


def test_manager_report_text_sort_and_null_keys(spark):
    staff = spark.createDataFrame([staff_row(1), staff_row(2, city=None)], STAFF_SCHEMA)
    c = T(2024, 5, 3)
    data = [("E1", 1, c, c, 0, 0)] * 97 + [("E1", 2, c, c, 0, 0)] * 106 + [("E1", None, c, c, 0, 0), ("E2", 1, c, c, 0, 0)]
    rep = severity.manager_report(_srs(spark, data), staff, D(2024, 5, 4))
    got = {(r["role"], r["manager"]): (r["May-03"], r["Total_SRs"]) for r in rep.collect()}
    assert got == {("Associate Manager", "AM1"): ("106 P2, 97 P1", 204), ("Manager", "M1"): ("106 P2, 97 P1", 204)}


# ------------------------------------------------------------ grid
def test_grid_fanout_and_zero_cells(spark):
    staff = spark.createDataFrame([staff_row(1), staff_row(2, is_active=False)], STAFF_SCHEMA)
    d = T(2024, 1, 2, 8)
    srs = _srs(spark, [("E1", 1, d, d, 0, 0), ("E1", 1, d, None, 0, 0)])
    acts = spark.createDataFrame([(1, 1, d, "Activity"), (2, 1, d, "Activity"), (3, 1, d, "Time Task"),
                                  (4, 1, d, "Note")], "id long, staff_id long, created_at timestamp_ntz, record_type string")
    out = grid.daily_staff_summary(staff, srs, acts, D(2024, 1, 1), D(2024, 1, 3))
    got = rows(out, "report_date", "open_srs", "closed_srs", "activity_count", "time_task_count")
    # 2 SRs x 3 activities on Jan 2: every count multiplied by the other side
    assert got == [(D(2024, 1, 1), 0, 0, 0, 0), (D(2024, 1, 2), 6, 3, 4, 2), (D(2024, 1, 3), 0, 0, 0, 0)]
    ind = grid.daily_staff_summary(staff, srs, acts, D(2024, 1, 1), D(2024, 1, 3), fanout="independent")
    assert (D(2024, 1, 2), 2, 1, 2, 1) in rows(ind, "report_date", "open_srs", "closed_srs", "activity_count",
                                               "time_task_count")
    assert grid.daily_staff_summary(staff, srs, acts, D(2024, 1, 3), D(2024, 1, 1)).count() == 0


def test_grid_manager_rule(spark):
    staff = spark.createDataFrame([staff_row(1, assoc_manager_tid="AM1", manager_tid="M9"),
                                   staff_row(2, assoc_manager_tid="AM7", manager_tid="M2"),
                                   staff_row(3, assoc_manager_tid="AM7", manager_tid="M9")], STAFF_SCHEMA)
    srs = _srs(spark, [])
    acts = spark.createDataFrame([], "id long, staff_id long, created_at timestamp_ntz, record_type string")
    day = D(2024, 1, 1)
    f = lambda am, m: {r["tech_id"] for r in grid.daily_staff_summary(staff, srs, acts, day, day, am, m).collect()}
    assert f(None, None) == {"T1", "T2", "T3"}
    assert f("AM1", None) == {"T1"}
    assert f("AM1", "M2") == {"T1", "T2"}


# ------------------------------------------------------------ search
def _hires(spark):
    hires = spark.createDataFrame(
        [(1, "REQ-50%", "Cand A", "Driver", "HR", "Open", "Joined", "Z1", 10, 20),
         (2, "REQ-2", "Cand B", "HR Partner", "OPS", "Hold", "Pending", "Z2", None, 20),
         (3, "REQ-3", "Cand C", "Installer", "HR", "Open", "Joined", "Z1", 11, None)],
        "id long, req_num string, name string, position string, department string, req_status string, "
        "hire_status string, zone string, old_emp_id long, manager_id long")
    emps = spark.createDataFrame([(10, "Ann", "Smith"), (11, "Bob", None), (20, "John", "Boss")],
                                 "id long, first_name string, last_name string")
    return hires, emps


def test_search_terms_filters_and_inner_manager(spark):
    hires, emps = _hires(spark)
    assert rows(search.search_hires(hires, emps, "smith"), "emp_id", "emp_full_name", "manager_name") == [
        (1, "Ann Smith", "John Boss")]
    assert rows(search.search_hires(hires, emps, None), "emp_id", "emp_full_name") == [(1, "Ann Smith"), (2, " ")]
    assert rows(search.search_hires(hires, emps, "req  zzz", pos_status="Hold"), "emp_id") == [(2,)]
    assert rows(search.search_hires(hires, emps, "50%"), "emp_id") == [(1,)]
    assert rows(search.search_hires(hires, emps, "", zone="Z2"), "emp_id") == [(2,)]


def test_search_spec(spark):
    hires, emps = _hires(spark)
    out = search.search_hires_spec(hires, emps, "dri", {"department": "HR", "manager_first_name": "Jo"})
    assert rows(out, "emp_id") == [(1,)]
    out = search.search_hires_spec(hires, emps, "  ", {"employee_last_name": "Sm"})
    assert rows(out, "emp_id") == [(1,)]


# ------------------------------------------------------------ changes
def test_history_and_staging_post_image(spark):
    master = spark.createDataFrame([staff_row(1, zone="A"), staff_row(2, team=None), staff_row(3)], STAFF_SCHEMA)
    staging = spark.createDataFrame(
        [("E1", "B", "X", "Lead", "N", None, "555"), ("E2", "Z", "Y", None, "N", "L", "555"),
         ("E3", "Z", "X", None, "A", "B", "1"), ("E3", "Q", "X", None, "A", "B", "2")],
        "emp_id string, zone string, team string, title string, firstname string, lastname string, mobile string")
    master = master.withColumn("title", F.lit("Lead")).withColumn("mobile", F.lit("0"))
    hist = changes.staff_change_history(master, staging, T(2024, 1, 1))
    # NULL team vs 'Y' is not a difference, but title 'Lead' vs NULL is not either -> no row
    assert rows(hist, "emp_id", "zone") == [("E1", "A"), ("E3", "Z")]
    c = hist.where("emp_id = 'E1'").first()["comments"]
    assert c == '{"changes":{"zone":{"old":"A","new":"B"},"team":{"old":"X","new":"X"},"title":{"old":"Lead","new":"Lead"}}}'
    post, rejects = changes.apply_staging(master, staging)
    got = {r["emp_id"]: (r["zone"], r["last_name"], r["title"]) for r in post.collect()}
    assert got == {"E1": ("B", None, "Lead"), "E2": ("Z", "L", None), "E3": ("Z", "B", None)}  # the larger of E3's two rows
    assert rows(rejects) == [("E3", 2)]
    assert post.columns == master.columns


def test_mileage_range_assignment(spark):
    alloc = spark.createDataFrame(
        [(1, 100, D(2024, 1, 1), D(2024, 1, 10), True), (1, 200, D(2024, 1, 5), D(2024, 1, 20), True),
         (1, 150, D(2024, 1, 5), D(2024, 1, 6), True), (1, 300, D(2024, 1, 21), None, True),
         (2, 400, D(2024, 1, 1), D(2024, 1, 31), False), (3, 500, D(2024, 1, 9), D(2024, 1, 1), True)],
        "van_number long, emp_id long, start_date date, end_date date, is_active boolean")
    mil = spark.createDataFrame([(1, D(2024, 1, 2)), (1, D(2024, 1, 5)), (1, D(2024, 1, 25)), (2, D(2024, 1, 3)),
                                 (3, D(2024, 1, 5)), (1, D(2024, 1, 5))],
                                "van_number long, mileage_date date").withColumn("emp_id", F.lit(-1).cast("long"))
    out = changes.assign_by_date_range(mil, alloc)
    assert rows(out, "van_number", "mileage_date", "emp_id") == [
        (1, D(2024, 1, 2), 100), (1, D(2024, 1, 5), 150), (1, D(2024, 1, 5), 150), (1, D(2024, 1, 25), -1),
        (2, D(2024, 1, 3), -1), (3, D(2024, 1, 5), -1)]


# ------------------------------------------------------------ JSON fields
def test_field_json_round_trip(spark):
    rows_df = spark.createDataFrame([(1, "Brand#1", None, 900.0), (2, "Brand#2", 7, 12.5)],
                                    "site long, p_brand string, p_size int, p_retailprice double")
    meta = spark.createDataFrame([("Brand", "B", "p_brand"), ("Size", "S", "p_size"), ("Price", "P", "p_retailprice"),
                                  ("Ghost", "G", "p_nope")], "field_name string, field_display_name string, column_name string")
    built = jsonfields.build_field_json(rows_df, meta)
    j = {r["site"]: r["field_info"] for r in built.collect()}
    assert j[1] == ('[{"field_name":"Brand","field_display_name":"B","value":"Brand#1","is_track_time":false},'
                    '{"field_name":"Ghost","field_display_name":"G","value":null,"is_track_time":false},'
                    '{"field_name":"Price","field_display_name":"P","value":900.0,"is_track_time":false},'
                    '{"field_name":"Size","field_display_name":"S","value":null,"is_track_time":false}]')
    val = jsonfields.validate_field_json(jsonfields.build_field_json(rows_df, meta, keep_row=True), meta)
    res = {(r["site"], r["column_name"]): r["validation_result"] for r in val.collect()}
    assert res[(1, "p_size")] == "MATCH"          # present NULL column
    assert res[(1, "p_nope")] == "MISMATCH"       # missing column
    assert all(v == "MATCH" for k, v in res.items() if k[1] != "p_nope")


def test_rewrite_keeps_other_elements_and_keys(spark):
    exec_rows = spark.createDataFrame(
        [(1, 5, "T5", '[{"field_name":"x","value":{"a":1}},{"field_name":"f","value":"2024-11-03 01:30:00","note":"n"}]'),
         (2, 9, "T9", '[{"field_name":"f","value":"2024-01-01 00:00:00"}]'),
         (3, 5, "T5", '[{"field_name":"g","value":"2024-01-01 00:00:00"}]')],
        "id long, staff_id long, tech_id string, project_data string")
    staff = spark.createDataFrame([staff_row(5, tech_id="T5")], STAFF_SCHEMA)
    out = {r["id"]: r["project_data"] for r in jsonfields.rewrite_field_time_to_utc(exec_rows, staff, "f").collect()}
    assert out[1] == ('[{"field_name":"x","value":{"a":1}},'
                      '{"field_name":"f","note":"n","value":"2024-11-03T06:30:00Z"}]')
    assert out[2] == '[{"field_name":"f","value":"2024-01-01 00:00:00"}]'   # no staff row: unchanged
    assert out[3] == '[{"field_name":"g","value":"2024-01-01 00:00:00"}]'   # field absent: unchanged
    prev = jsonfields.field_time_to_utc(exec_rows, staff, "f").collect()
    assert [(r["original_value"], r["converted_value_utc_iso8601"]) for r in prev] == [
        ("2024-11-03 01:30:00", "2024-11-03T06:30:00Z")]


# ------------------------------------------------------------ projects
DEF_SCHEMA = ("id long, recurrence string, scope string, scope_data string, start_date date, end_date date, "
              "cycle_index int, cycle_start_date date, cycle_end_date date")


def test_next_cycles_month_end_clamp(spark):
    defs = spark.createDataFrame([
        (1, "monthly", "Global", None, D(2024, 1, 30), D(2024, 12, 31), None, None, None),
        (2, "quarterly", "Global", None, D(2024, 1, 1), D(2024, 12, 31), 2, D(2024, 2, 1), D(2024, 5, 30)),
        (3, "one-time", "Global", None, D(2024, 1, 1), D(2024, 3, 1), 7, None, None),
        (4, "yearly", "Global", None, D(2024, 2, 28), D(2025, 1, 1), None, None, None),
        (5, "weekly", "Global", None, D(2024, 1, 1), D(2024, 2, 1), None, None, None),
        (6, None, "Global", None, D(2024, 1, 1), D(2024, 2, 1), None, None, None)], DEF_SCHEMA)
    cyc, rej = projects.next_project_cycles(defs)
    got = {r["id"]: (r["next_cycle_index"], r["next_start_date"], r["next_end_date"]) for r in cyc.collect()}
    assert got == {1: (1, D(2024, 1, 31), D(2024, 2, 28)), 2: (3, D(2024, 5, 31), D(2024, 8, 30)),
                   3: (1, D(2024, 1, 1), D(2024, 3, 1)), 4: (1, D(2024, 2, 29), D(2025, 2, 27))}
    assert sorted(r["id"] for r in rej.collect()) == [5, 6]


def test_skeleton_scopes(spark):
    defs = spark.createDataFrame([
        (1, "one-time", "Zone", "ASIA, EUROPE", D(2024, 1, 1), D(2024, 2, 1), None, None, None),
        (2, "one-time", "Specified Sites", "S1,S1,S9", D(2024, 1, 1), D(2024, 2, 1), None, None, None),
        (3, "one-time", "Specified Sites", "", D(2024, 1, 1), D(2024, 2, 1), None, None, None),
        (4, "one-time", "Global", None, D(2024, 1, 1), D(2024, 2, 1), None, None, None),
        (5, "one-time", "Global", None, D(2024, 1, 1), D(2024, 2, 1), None, None, None),
        (6, "one-time", "Nowhere", None, D(2024, 1, 1), D(2024, 2, 1), None, None, None),
        (7, "one-time", "Nowhere", None, D(2024, 1, 1), D(2024, 2, 1), None, None, None)], DEF_SCHEMA)
    sites = spark.createDataFrame([("S1", "ASIA", "N1", "Depot"), ("S2", "EUROPE", "N2", "Super")],
                                  "site string, zone string, state string, store_type string")
    existing = spark.createDataFrame([(5, "S1", 1, "done"), (7, "S1", 1, "done")],
                                     "project_id long, site string, cycle_index int, execution_status string")
    out, rej = projects.project_skeleton(defs, sites, existing)
    # zone list is not trimmed: ' EUROPE' matches nothing; listed sites are kept as given
    assert rows(out, "project_id", "site") == [(1, "S1"), (2, "S1"), (2, "S1"), (2, "S9"), (4, "S1"), (4, "S2")]
    # project 6 rejected for its scope; 7 has the same bad scope but its cycle exists -> silent
    assert [r["id"] for r in rej.collect()] == [6]
    post = {r["id"]: r["cycle_index"] for r in projects.advance_definitions(defs, existing).collect()}
    assert post == {1: 1, 2: 1, 3: 1, 4: 1, 5: None, 6: None, 7: None}


# ------------------------------------------------------------ jobs
def test_job_slots_and_fold(spark):
    master = spark.createDataFrame([(1, "m", T(2024, 1, 31), 1, "month"), (2, "q", T(2024, 1, 1), 15, "minute"),
                                    (3, "y", T(2024, 1, 1), 1, "year")],
                                   "id long, name string, created_at timestamp_ntz, interval_value int, interval_unit string")
    runs = spark.createDataFrame([
        (1, "m", T(2024, 3, 5), T(2024, 3, 5, 1), "SUCCESS", None),
        (2, "q", T(2023, 12, 31, 23, 50), T(2024, 1, 1), "FAILED", "boom"),
        (3, "q", T(2024, 1, 1, 0, 31), None, None, None),
        (4, "y", T(2025, 1, 1, 5), T(2025, 1, 1, 6), "SUCCESS", None),
        (5, "nope", T(2024, 1, 1), None, None, None)],
        "event_seq long, name string, started_at timestamp_ntz, ended_at timestamp_ntz, status string, error_message string")
    slots, rej = jobs.job_slots(runs, master)
    got = {r["event_seq"]: (r["run_count"], r["scheduled_for"], r["next_run_at"]) for r in slots.collect()}
    # month = 30 days for counting (34 days -> slot 2) but calendar months when adding (clamped)
    assert got[1] == (2, T(2024, 2, 29), T(2024, 3, 31))
    assert got[2] == (0, T(2023, 12, 31, 23, 45), T(2024, 1, 1))      # before creation: floor, not truncation
    assert got[3] == (3, T(2024, 1, 1, 0, 30), T(2024, 1, 1, 0, 45))
    assert got[4] == (2, T(2025, 1, 1), T(2026, 1, 1))                 # 366 days > 365.25
    assert [r["event_seq"] for r in rej.collect()] == [5]
    log, mst, _ = jobs.apply_job_events(runs, master)
    lg = {r["log_id"]: r["status"] for r in log.collect()}
    assert lg == {"1:1": "SUCCESS", "2:2": "FAILED", "2:3": "RUNNING", "3:4": "SUCCESS"}
    m = {r["name"]: r for r in mst.collect()}
    assert m["q"]["last_run_status"] == "RUNNING" and m["q"]["last_run_end_at"] == T(2024, 1, 1)
    assert m["q"]["last_successful_at"] is None and m["q"]["last_run_start_at"] == T(2024, 1, 1, 0, 31)
    assert m["m"]["last_successful_at"] == T(2024, 3, 5, 1) and m["m"]["next_run_at"] == T(2024, 3, 31)


# ------------------------------------------------------------ quality
CAT = "table_name string, column_name string, ordinal_position int, data_type string, max_length int, is_nullable string, column_default string"


def test_schema_diff_and_swap_property(spark):
    src = spark.createDataFrame([("t1", "id", 1, "int8", None, "NO", None), ("t1", "name", 2, "varchar", 50, "YES", None),
                                 ("t1", "zone", 3, "text", None, "YES", "now()"), ("t2", "id", 1, "int4", None, "NO", None)], CAT)
    tgt = spark.createDataFrame([("t1", "id", 1, "int4", None, "NO", None), ("t1", "name", 2, "varchar", 80, "YES", None),
                                 ("t1", "old", 3, "text", None, "YES", None), ("t3", "id", 1, "int4", None, "NO", None)], CAT)
    tabs = rows(quality.schema_diff_tables(src, tgt))
    assert tabs == [("Added Tables", "t2", "N/A"), ("Removed Tables", "t3", "N/A")]
    cols = {(r["column"], r["change"]): r["sql_query"] for r in quality.schema_diff_columns(src, tgt).collect()}
    assert cols == {("zone", "added"): "ALTER TABLE public.t1 ADD COLUMN zone text NULL DEFAULT now();",
                    ("old", "removed"): "ALTER TABLE public.t1 DROP COLUMN old;",
                    ("id", "modified"): "ALTER TABLE public.t1 ALTER COLUMN id TYPE int8;",
                    ("name", "modified"): "ALTER TABLE public.t1 ALTER COLUMN name TYPE varchar(50);"}
    swapped = {(r["column"], r["change"]) for r in quality.schema_diff_columns(tgt, src).collect()}
    flip = {"added": "removed", "removed": "added", "modified": "modified"}
    assert swapped == {(c, flip[k]) for c, k in cols}


def test_pair_flags_null_modes(spark):
    df = spark.createDataFrame([(None, None), ("a", None), ("a", "a"), ("a", "b")], "x string, y string")
    differ = [r["diff_x__y"] for r in quality.pair_diff_flags(df, [("x", "y")], "differ").collect()]
    equal = [r["diff_x__y"] for r in quality.pair_diff_flags(df, [("x", "y")], "equal").collect()]
    assert differ == [True, True, False, True] and equal == [False, True, False, True]


def test_long_values_and_recent(spark):
    df = spark.createDataFrame([("x" * 31, 1.5, None), ("short", 1.0, "y" * 40)], "a string, b double, c string")
    got = [tuple(r) for r in quality.long_values(df, 30).collect()]
    assert got == [("x" * 31, None, None), (None, None, "y" * 40)]
    ev = spark.createDataFrame([(T(2024, 1, 12, 23),), (T(2024, 1, 13),), (T(2024, 1, 25),)], "ts timestamp_ntz")
    assert len(quality.recent_rows(ev, "ts", T(2024, 1, 20)).collect()) == 2


# ------------------------------------------------------------ mail, states
def test_sorted_recipients(spark):
    rec = spark.createDataFrame([(1, 1, "To", "Zed, A", "z@x"), (1, 2, "To", "Amy Brown", "b@x"),
                                 (1, 3, "To", "Cher", "c@x"), (1, 4, "To", "Ann ", "e@x"), (1, 5, "Cc", "Solo One", "s@x")],
                                "message_id long, position long, type string, name string, address string")
    got = {r["type"]: (r["sorted_addresses"], r["reordered"]) for r in mail.sorted_recipients(rec).collect()}
    assert got == {"To": ("e@x; b@x; c@x; z@x", True), "Cc": ("s@x", False)}


def test_state_master(spark):
    s = state_master(spark)
    assert s.count() == 50 and s.where("state_code = 'DC'").count() == 0
    assert s.where("state_name = 'West Virginia'").first()["state_code"] == "WV"


def test_strict_mode_raises(spark):
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError
    defs = spark.createDataFrame([(1, "weekly", "Global", None, D(2024, 1, 1), D(2024, 2, 1), None, None, None)], DEF_SCHEMA)
    with pytest.raises((PySparkException, Py4JJavaError), match="Invalid recurrence type: weekly"):
        projects.next_project_cycles(defs, strict=True)[0].collect()
    defs = spark.createDataFrame([(1, "monthly", "Moon", None, D(2024, 1, 1), D(2024, 2, 1), None, None, None)], DEF_SCHEMA)
    sites = spark.createDataFrame([("S1", "ASIA", "N1", "Depot")], "site string, zone string, state string, store_type string")
    existing = spark.createDataFrame([], "project_id long, site string, cycle_index int, execution_status string")
    with pytest.raises((PySparkException, Py4JJavaError), match="Invalid scope: Moon"):
        projects.project_skeleton(defs, sites, existing, strict=True)[0].collect()
    master = spark.createDataFrame([(1, "a", T(2024, 1, 1), 1, "day")],
                                   "id long, name string, created_at timestamp_ntz, interval_value int, interval_unit string")
    runs = spark.createDataFrame([(1, "zzz", T(2024, 1, 2))], "event_seq long, name string, started_at timestamp_ntz")
    with pytest.raises((PySparkException, Py4JJavaError), match="Job not found: zzz"):
        jobs.job_slots(runs, master, strict=True)[0].collect()
    assert jobs.job_slots(runs, master)[0].count() == 0


def test_metadata_of_any_size_gives_the_same(spark):
    rows_df = spark.createDataFrame([(1, "a", T(2024, 1, 1, 10, 0, 0, 500000), ["x", "y"]), (2, None, None, None)],
                                    "site long, code string, at timestamp_ntz, tags array<string>")
    meta = spark.createDataFrame([("C", "C", "code"), ("C2", "C2", "code"), ("A", "A", "at"), ("T", "T", "tags"),
                                  ("Ghost", "G", "nope"), (None, "N", None)],
                                 "field_name string, field_display_name string, column_name string")
    small = jsonfields.build_field_json(rows_df, meta, keep_row=True)
    joined = jsonfields.build_field_json(rows_df, meta, keep_row=True, small_bytes=0)
    assert rows(small, "site", "field_info") == rows(joined, "site", "field_info")
    assert '"value":"2024-01-01T10:00:00.5"' in small.where("site = 1").first()["field_info"]
    bad = jsonfields.validate_field_json(joined, meta).where("validation_result <> 'MATCH'")
    assert {r["column_name"] for r in bad.collect()} == {"nope"}
    none = jsonfields.build_field_json(rows_df, meta.where("false"), small_bytes=-1)
    assert {r["field_info"] for r in none.collect()} == {"[]"}


def test_repeated_staging_rows(spark):
    master = spark.createDataFrame([("E1", "old", "t", "x", "f", "l", "m"), ("E2", "old", "t", "x", "f", "l", "m")],
                                   "emp_id string, zone string, team string, title string, first_name string, last_name string, mobile string")
    staging = spark.createDataFrame([("E1", "new", "t", "x", "f", "l", "m")] * 2 + [
        ("E2", "b", "t", "x", "f", "l", "m"), ("E2", None, "z", "x", "f", "l", "m")],
        "emp_id string, zone string, team string, title string, firstname string, lastname string, mobile string")
    image, several = changes.apply_staging(master, staging)
    assert rows(image, "emp_id", "zone") == [("E1", "new"), ("E2", "b")]
    assert rows(several, "emp_id", "copies") == [("E2", 2)]


def test_open_ends_cost_the_fact_days_only(spark):
    mileage = spark.createDataFrame([(1, D(2024, 1, 3), -1)], "van_number long, mileage_date date, emp_id long")
    alloc = spark.createDataFrame([(1, 7, D(1, 1, 1), D(9999, 12, 31), True), (1, 8, D(2024, 1, 3), D(9999, 12, 31), True),
                                   (1, 9, D(2024, 1, 4), D(9999, 12, 31), True), (1, 6, D(2024, 1, 3), None, True)],
                                  "van_number long, emp_id long, start_date date, end_date date, is_active boolean")
    assert rows(changes.assign_by_date_range(mileage, alloc), "emp_id") == [(8,)]
    assert changes.assign_by_date_range(mileage.where("false"), alloc).count() == 0


@pytest.mark.parametrize("id_type", ["long", "string"])
def test_allocation_without_start_covers_no_day(spark, id_type):
    mileage = spark.createDataFrame([(1, D(2024, 1, 3), 5), (2, D(2024, 1, 3), 5)], "van_number long, mileage_date date, emp_id long")
    alloc = spark.createDataFrame([(1, 7, None, D(9999, 12, 31), True), (2, 8, None, D(2024, 1, 3), True),
                                   (2, 9, D(2024, 1, 1), D(2024, 1, 3), True), (2, 6, None, None, True)],
                                  "van_number long, emp_id long, start_date date, end_date date, is_active boolean")
    mileage, alloc = (x.withColumn("emp_id", x["emp_id"].cast(id_type)) for x in (mileage, alloc))
    out = changes.assign_by_date_range(mileage, alloc)
    assert rows(out.selectExpr("van_number", "int(emp_id) AS emp_id"), "van_number", "emp_id") == [(1, 5), (2, 9)]


def test_end_of_a_logged_run(spark):
    log = spark.createDataFrame([("1:1", 1, "RUNNING", None, None), ("1:2", 1, "RUNNING", None, None), ("2:9", 2, "RUNNING", None, None)],
                                "log_id string, job_id long, status string, ended_at timestamp_ntz, error_message string")
    master = spark.createDataFrame([(1, "SUCCESS", T(2023, 1, 1)), (2, "FAILED", None), (3, "kept", None)],
                                   "id long, last_run_status string, last_successful_at timestamp_ntz")
    ends = spark.createDataFrame([("1:1", "SUCCESS", T(2024, 1, 2), None), ("1:1", "FAILED", T(2024, 1, 1), "early"),
                                  ("1:2", None, T(2024, 1, 3), "e"), ("7:7", "SUCCESS", T(2024, 1, 4), None)],
                                 "log_id string, status string, ended_at timestamp_ntz, error_message string")
    new_log, new_master, rejects = jobs.end_job_runs(log, master, ends)
    assert rows(new_log, "log_id", "status", "error_message") == [("1:1", "SUCCESS", None), ("1:2", None, "e"), ("2:9", "RUNNING", None)]
    assert rows(new_master, "id", "last_run_status", "last_successful_at", "last_run_end_at") == [
        (1, None, T(2024, 1, 2), T(2024, 1, 3)), (2, "FAILED", None, None), (3, "kept", None, None)]
    assert rows(rejects, "log_id") == [("7:7",)]


def test_interval_spellings(spark):
    master = spark.createDataFrame([(i, n, T(2024, 1, 1), 2, n) for i, n in enumerate(["mins", "HRS", " d ", "mons", "decade", "fortnight", "ms"])],
                                   "id long, name string, created_at timestamp_ntz, interval_value int, interval_unit string")
    runs = spark.createDataFrame([(i, n, T(2024, 1, 1, 5)) for i, n in enumerate(["mins", "HRS", " d ", "mons", "decade", "fortnight", "ms"])],
                                 "event_seq long, name string, started_at timestamp_ntz")
    slots, rejects = jobs.job_slots(runs, master)
    assert rows(slots, "event_seq", "run_count") == [(0, 151), (1, 3), (2, 1), (3, 1), (4, 1), (6, 9_000_001)]
    assert rows(rejects, "name", "reason") == [("fortnight", "invalid interval unit: fortnight")]


def test_spec_on_any_column_and_other_recipient_types(spark):
    hires = spark.createDataFrame([(1, "r", "h", "p", "d", 5, 6), (2, "r", "h", "p", "d", 7, 6)],
                                  "id long, req_num string, name string, position string, department string, old_emp_id long, manager_id long")
    emp = spark.createDataFrame([(5, "A", "B", "x@y"), (6, "M", "N", "m@y"), (7, "C", "D", "z@y")],
                                "id long, first_name string, last_name string, mail string")
    spec = {"mail": ("employee", "mail", "like"), "boss": ("manager", "mail", "eq")}
    assert rows(search.search_hires_spec(hires, emp, None, {"mail": "x@", "boss": "m@y"}, spec), "emp_id") == [(1,)]
    from fieldlens.plans import mail
    to = spark.createDataFrame([(1, i, k, n, n) for k in ("To", "Bcc") for i, n in enumerate(["Zed", "Amy"])],
                               "message_id long, position long, type string, name string, address string")
    assert rows(mail.sorted_recipients(to), "type", "reordered", "sorted_addresses") == [
        ("Bcc", False, "Zed; Amy"), ("To", True, "Amy; Zed")]


def test_recent_dates_with_a_noon(spark):
    from fieldlens.plans import quality
    df = spark.createDataFrame([(D(2024, 1, 13),), (D(2024, 1, 14),)], "d date")
    assert rows(quality.recent_rows(df, "d", dt.datetime(2024, 1, 20, 12)), "d") == [(D(2024, 1, 14),)]
    assert quality.recent_rows(df, "d", dt.datetime(2024, 1, 20)).count() == 2


WRITES = {"p24_manager_report_files", "p9_update_stored_master", "p3_json_document", "p1_from_stored_counts",
          "p4_from_stored_trend", "p18_run_outcomes",
          "p8_change_history_by_digest"}


def test_building_a_query_runs_no_job(spark, sf_check):
    from fieldlens.registry import QUERIES
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    for name, (build, _) in QUERIES.items():
        if name not in WRITES:  # its build is a write, or compares checksums
            build(spark, sf_check)
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_validate_numbers_by_value(spark):
    rows_df = spark.createDataFrame([(1, 1000.0, "1000")], "site long, price double, code string")
    meta = spark.createDataFrame([("P", "P", "price"), ("C", "C", "code")],
                                 "field_name string, field_display_name string, column_name string")
    foreign = rows_df.withColumn("field_info", F.lit('[{"field_name":"P","value":1e3},{"field_name":"C","value":"1000.0"}]'))
    res = {r["column_name"]: r["validation_result"] for r in jsonfields.validate_field_json(foreign, meta).collect()}
    assert res == {"price": "MATCH", "code": "MISMATCH"}   # text column: '1000' is not '1000.0'


def test_helpers_split_weeks_units(spark):
    from fieldlens.functions.dates import add_units, date_bucket, unit_months, unit_us

    def plus(count, unit):
        return add_units(F.col("c"), F.lit(count), unit_months(F.lit(unit)), unit_us(F.lit(unit)))

    df = spark.createDataFrame([("a|b||c", T(2024, 1, 3, 10), T(2024, 1, 31))], "s string, t timestamp_ntz, c timestamp_ntz")
    r = df.select(pg_split(F.col("s"), "|").alias("parts"), pg_split(F.col("s"), ".").alias("dot"),
                  date_bucket(F.col("t"), "weekly").alias("wk"), date_bucket(F.col("t"), "monthly").alias("mo"),
                  date_bucket(F.col("t"), None).alias("dy"),
                  plus(1, "Months").alias("m1"),
                  plus(-6, "hours").alias("h"),
                  plus(1, "year").alias("y")).first()
    assert r["parts"] == ["a", "b", "", "c"] and r["dot"] == ["a|b||c"]
    assert r["wk"] == D(2024, 1, 1) and r["mo"] == D(2024, 1, 1) and r["dy"] == D(2024, 1, 3)
    assert r["m1"] == T(2024, 2, 29) and r["h"] == T(2024, 1, 30, 18) and r["y"] == T(2025, 1, 31)


def test_reports_share_precomputed_counts(spark):
    staff = spark.createDataFrame([staff_row(1), staff_row(2)], STAFF_SCHEMA)
    c = T(2024, 5, 3)
    srs = _srs(spark, [("E1", 1, c, c, 0, 0), ("E2", 7, c, c, 0, 0), ("E2", 7, c, c, 0, 0)])
    counts = severity.closed_counts(srs, D(2024, 5, 9))
    for fn in (severity.severity_summary, severity.severity_pivot, severity.manager_report):
        assert rows(fn(None, staff, D(2024, 5, 9), counts=counts)) == rows(fn(srs, staff, D(2024, 5, 9)))


def test_catalog_columns_feed_schema_diff(spark):
    from fieldlens.sources.catalog import catalog_columns
    dev = {"orders": spark.createDataFrame([], "o_id long not null, o_note string, o_ts timestamp_ntz"),
           "lines": spark.createDataFrame([], "l_id long")}
    qa = {"orders": spark.createDataFrame([], "o_id int not null, o_ts timestamp_ntz, o_old double"),
          "legacy": spark.createDataFrame([], "x int")}
    src, tgt = catalog_columns(spark, dev), catalog_columns(spark, qa)
    assert rows(src, "table_name", "column_name", "data_type", "is_nullable") == [
        ("lines", "l_id", "int8", "YES"), ("orders", "o_id", "int8", "NO"), ("orders", "o_note", "text", "YES"),
        ("orders", "o_ts", "timestamp", "YES")]
    tabs = rows(quality.schema_diff_tables(src, tgt))
    assert tabs == [("Added Tables", "lines", "N/A"), ("Removed Tables", "legacy", "N/A")]
    cols = {(r["column"], r["change"]): r["sql_query"] for r in quality.schema_diff_columns(src, tgt).collect()}
    assert cols == {("o_note", "added"): "ALTER TABLE public.orders ADD COLUMN o_note text NULL;",
                    ("o_old", "removed"): "ALTER TABLE public.orders DROP COLUMN o_old;",
                    ("o_id", "modified"): "ALTER TABLE public.orders ALTER COLUMN o_id TYPE int8;"}


def test_manager_report_written_per_manager(spark):
    import os
    import tempfile
    staff = spark.createDataFrame([staff_row(1), staff_row(2, assoc_manager_tid="AM2", manager_tid="M2")], STAFF_SCHEMA)
    c = T(2024, 5, 3)
    rep = severity.manager_report(_srs(spark, [("E1", 1, c, c, 0, 0), ("E2", 9, c, c, 0, 0)]), staff, D(2024, 5, 4))
    out = tempfile.mkdtemp(prefix="mgr-report-") + "/report"
    severity.write_manager_report(rep, out)
    folders = sorted(f for f in os.listdir(out) if f.startswith("report="))
    assert folders == ["report=AM_AM1", "report=AM_AM2", "report=MGR_M1", "report=MGR_M2"]
    back = spark.read.parquet(out).where("report = 'MGR_M2'").collect()
    assert [(r["tech_id"], r["May-03"], r["Total_SRs"]) for r in back] == [("T2", "1 P5+", 1)]


def test_sql_surface_defaults_and_named_args(spark):
    from fieldlens.sql_functions import register_sql_functions
    staff = spark.createDataFrame([staff_row(1, assoc_manager_tid="AM1", manager_tid="M9")], STAFF_SCHEMA)
    d = T(2024, 1, 2, 8)
    srs = _srs(spark, [("E1", 1, d, d, 0, 0)])
    acts = spark.createDataFrame([(1, 1, d, "Activity")], "id long, staff_id long, created_at timestamp_ntz, record_type string")
    made = register_sql_functions(spark, {"siebel_srs": srs, "staff_master": staff, "project_activities": acts})
    assert made == ["get_severity_summary", "GetSeverityCounts", "get_daily_summary", "pivot_severity_summary_json"]
    js = [r["json"] for r in spark.sql("SELECT * FROM pivot_severity_summary_json(DATE'2024-01-04')").collect()]
    assert js == ['{"tech_id":"T1","first_name":"Ann","state":"S","city":"C","zone":"Z","team":"X","Total SRs":1,'
                  '"2024-01-01":null,"2024-01-02":"1 P1","2024-01-03":null}']
    assert spark.sql("SELECT * FROM pivot_severity_summary_json(DATE'2024-01-01')").count() == 0   # 1st: empty
    spark.sql("SELECT * FROM get_severity_summary()").collect()          # CURRENT_DATE default runs
    got = spark.sql("SELECT * FROM get_daily_summary(DATE'2024-01-01', DATE'2024-01-03', assoc_manager_tid => 'AM1')")
    assert rows(got, "report_date", "open_srs", "activity_count") == [
        (D(2024, 1, 1), 0, 0), (D(2024, 1, 2), 1, 1), (D(2024, 1, 3), 0, 0)]
    assert spark.sql("SELECT * FROM get_daily_summary(DATE'2024-01-01', DATE'2024-01-03', manager_tid => 'M1')").count() == 0
    summ = spark.sql("SELECT * FROM get_severity_summary(DATE'2024-01-20')")
    assert rows(summ, "tech_id", "bucket", "count") == [("T1", "1", 1)]
    cnt = spark.sql("SELECT * FROM GetSeverityCounts(DATE'2024-01-01', DATE'2024-01-31', NULL, NULL, 'monthly')").collect()
    assert [(r["aggregation_date"], r["open_sev1"], r["close_sev1"]) for r in cnt] == [(D(2024, 1, 1), 1, 1)]


def test_spark_catalog_databases_compare(spark):
    import tempfile
    from fieldlens.sources.catalog import spark_catalog_columns
    loc = tempfile.mkdtemp(prefix="catalog-")
    for db in ("fl_dev", "fl_qa"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{loc}/{db}'")
    spark.sql("CREATE TABLE IF NOT EXISTS fl_dev.jobs (id BIGINT, name STRING, note STRING) USING parquet")
    spark.sql("CREATE TABLE IF NOT EXISTS fl_qa.jobs (id INT, name STRING) USING parquet")
    spark.sql("CREATE TABLE IF NOT EXISTS fl_qa.old_logs (id INT) USING parquet")
    src, tgt = spark_catalog_columns(spark, "fl_dev"), spark_catalog_columns(spark, "fl_qa")
    assert rows(quality.schema_diff_tables(src, tgt)) == [("Removed Tables", "old_logs", "N/A")]
    got = {(r["column"], r["change"]) for r in quality.schema_diff_columns(src, tgt).collect()}
    assert got == {("note", "added"), ("id", "modified")}


def test_term_ending_in_backslash_escapes_the_closing_wildcard(spark):
    hires = spark.createDataFrame([(1, "AB%", 9), (2, "AB%x", 9), (3, "ab", 9)],
                                  "id long, req_num string, manager_id long").select(
        "*", F.lit(None).cast("long").alias("old_emp_id"), F.lit("Open").alias("req_status"),
        F.lit("J").alias("hire_status"), F.lit("Z").alias("zone"))
    emps = spark.createDataFrame([(9, "Boss", "Man")], "id long, first_name string, last_name string")
    # pattern '%b\\%' : ends with 'b%' (PostgreSQL semantics of '%' || term || '%')
    assert rows(search.search_hires(hires, emps, "b\\"), "emp_id") == [(1,)]


def test_validate_with_repeated_and_null_field_names(spark):
    rows_df = spark.createDataFrame([(1, "B1", 5)], "site long, p_brand string, p_size int")
    meta = spark.createDataFrame([("Brand", "B", "p_brand"), ("Size", "S", "p_size")],
                                 "field_name string, field_display_name string, column_name string")
    built = jsonfields.build_field_json(rows_df, meta, keep_row=True)
    meta2 = spark.createDataFrame([("Brand", "B", "p_brand"), ("Brand", "B2", "p_size"), (None, "X", "p_size")],
                                  "field_name string, field_display_name string, column_name string")
    got = rows(jsonfields.validate_field_json(built, meta2), "column_name", "json_value", "validation_result")
    assert got == [("p_brand", "B1", "MATCH"), ("p_size", "B1", "MISMATCH")]


def test_mileage_winner_with_null_emp_ids(spark):
    alloc = spark.createDataFrame(
        [(1, None, D(2024, 1, 5), D(2024, 1, 10), True), (1, 3, D(2024, 1, 1), D(2024, 1, 10), True),
         (2, None, D(2024, 1, 5), D(2024, 1, 10), True), (2, 4, D(2024, 1, 5), D(2024, 1, 10), True)],
        "van_number long, emp_id long, start_date date, end_date date, is_active boolean")
    mil = spark.createDataFrame([(1, D(2024, 1, 6), -1), (1, D(2024, 1, 2), -1), (2, D(2024, 1, 6), -1)],
                                "van_number long, mileage_date date, emp_id long")
    got = rows(changes.assign_by_date_range(mil, alloc), "van_number", "mileage_date", "emp_id")
    # latest start wins even with a NULL emp_id; at an equal start the NULL emp_id comes last
    assert got == [(1, D(2024, 1, 2), 3), (1, D(2024, 1, 6), None), (2, D(2024, 1, 6), 4)]


def test_trend_week_boundary_invalid_level_and_managers(spark):
    srs = _srs(spark, [("E1", 2, T(2024, 1, 7, 23), None, 1, 1),     # Sunday -> week of Mon 2024-01-01
                       ("E1", 2, T(2024, 1, 8, 0), None, 1, 2),      # Monday -> week of 2024-01-08
                       ("E1", 2, T(2024, 1, 8, 5), None, 3, 2)])
    wk = {r["aggregation_date"]: r["open_sev2"] for r in
          severity.severity_trend(srs, D(2024, 1, 1), D(2024, 1, 31), level="weekly").collect()}
    assert wk == {D(2024, 1, 1): 1, D(2024, 1, 8): 2}
    bad = {r["aggregation_date"] for r in severity.severity_trend(srs, D(2024, 1, 1), D(2024, 1, 31), level="yearly").collect()}
    assert bad == {D(2024, 1, 7), D(2024, 1, 8)}                    # unknown level: daily
    both = severity.severity_trend(srs, D(2024, 1, 1), D(2024, 1, 31), assoc_mgr_id=1, manager_id=2).collect()
    assert [(r["aggregation_date"], r["open_sev2"]) for r in both] == [(D(2024, 1, 8), 1)]


def test_recent_rows_on_zone_aware_timestamps(spark):
    ev = spark.createDataFrame([(T(2024, 1, 12, 23),), (T(2024, 1, 13, 0),)], "ts timestamp")
    got = quality.recent_rows(ev, "ts", T(2024, 1, 20)).collect()
    assert [r["ts"] for r in got] == [T(2024, 1, 13, 0)]
    dates = spark.createDataFrame([(D(2024, 1, 12),), (D(2024, 1, 13),)], "d date")
    assert [r["d"] for r in quality.recent_rows(dates, "d", D(2024, 1, 20)).collect()] == [D(2024, 1, 13)]


def test_sql_surface_with_bound_parameters(spark):
    from fieldlens.sql_functions import register_sql_functions
    hires, emps = _hires(spark)
    register_sql_functions(spark, {"new_hires": hires, "employees": emps})
    got = spark.sql("SELECT * FROM search_all_emp(:text, pos_status_filter => :pos)",
                    args={"text": "smith", "pos": "Open"})
    assert rows(got, "emp_id", "manager_name") == [(1, "John Boss")]
    none = spark.sql("SELECT * FROM search_all_emp(:text)", args={"text": None})
    assert rows(none, "emp_id") == [(1,), (2,)]


def test_pg_split_empty_delimiter_and_keyless_join(spark):
    from fieldlens.operators.joins import left_join
    df = spark.createDataFrame([("a,b",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(pg_split(F.col("s"), "")).collect()] == [["a,b"], [], None]
    with pytest.raises(ValueError):
        left_join(df, df.select(F.col("s").alias("t")), [])


def test_mileage_winner_with_text_emp_ids(spark):
    alloc = spark.createDataFrame(
        [(1, None, D(2024, 1, 5), D(2024, 1, 10), True), (1, "E3", D(2024, 1, 1), D(2024, 1, 10), True),
         (2, None, D(2024, 1, 5), D(2024, 1, 10), True), (2, "E4", D(2024, 1, 5), D(2024, 1, 10), True),
         (2, "E2", D(2024, 1, 5), D(2024, 1, 10), True)],
        "van_number long, emp_id string, start_date date, end_date date, is_active boolean")
    mil = spark.createDataFrame([(1, D(2024, 1, 6), "x"), (1, D(2024, 1, 2), "x"), (2, D(2024, 1, 6), "x")],
                                "van_number long, mileage_date date, emp_id string")
    got = rows(changes.assign_by_date_range(mil, alloc), "van_number", "mileage_date", "emp_id")
    assert got == [(1, D(2024, 1, 2), "E3"), (1, D(2024, 1, 6), None), (2, D(2024, 1, 6), "E2")]


def test_spark_catalog_columns_with_temp_views(spark):
    from fieldlens.sources.catalog import spark_catalog_columns
    spark.sql("CREATE DATABASE IF NOT EXISTS fl_views")
    spark.createDataFrame([(1, "a")], "k long, v string").createOrReplaceTempView("fl_tmp_view")
    names = {r["table_name"] for r in spark_catalog_columns(spark, "fl_views", include_temp_views=True).collect()}
    assert "fl_tmp_view" in names
    assert "fl_tmp_view" not in {r["table_name"] for r in spark_catalog_columns(spark, "fl_views").collect()}


def test_columns_with_the_names_of_working_columns_come_back(spark):
    from fieldlens.operators.joins import left_join, spare_names
    from fieldlens.operators.updates import apply_by_key, one_per_key
    assert spare_names(["Place", "place_"], "place", "zero") == ["place__", "zero"]
    base = spark.createDataFrame([(1, "a", 7, 8, 9), (None, "b", 5, 5, 5)], "id long, place string, zero int, matched int, key_id int")
    other = spark.createDataFrame([(1, "new", 3)], "k long, place_ string, zero_ int")
    got = sorted(left_join(base, other, [("id", "k")]).collect(), key=lambda r: r["zero"])
    assert [tuple(r) for r in got] == [(None, "b", 5, 5, 5, None, None, None), (1, "a", 7, 8, 9, 1, "new", 3)]
    changes = spark.createDataFrame([(1, "z", "y")], "id long, row string, least string")
    one, several = one_per_key(changes, ["id"])
    assert one.columns == changes.columns and several.count() == 0
    out = apply_by_key(base, one, ["id"], {"place": "row"}).orderBy("zero").collect()
    assert [tuple(r) for r in out] == [(None, "b", 5, 5, 5), (1, "z", 7, 8, 9)]
