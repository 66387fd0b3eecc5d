"""Brute-force checks on random small inputs.

Each pipeline is compared with a direct Python evaluation of the
reference's literal statement (nested loops over rows), for several
seeds: P5's pre-aggregated rewrite against the double left join, P10's
day-expanded equi-join against the range UPDATE with the stated
tie-break, P2's pivot text against per-day correlated aggregates, and
the NULL-aside left join against a plain left join.
"""
import datetime as dt
import random
from collections import Counter, defaultdict

import pytest

from fieldlens.operators.joins import left_join
from fieldlens.plans import changes, grid, severity

D = dt.date
T = dt.datetime
SEEDS = [1, 2, 3]

STAFF_SCHEMA = ("id long, emp_id string, tech_id string, first_name string, last_name string, state string, "
                "city string, zone string, team string, assoc_manager_tid string, manager_tid string, "
                "time_zone string, is_active boolean")
SRS_SCHEMA = ("siebel_id string, severity int, open_date timestamp_ntz, closed_date timestamp_ntz, "
              "assoc_manager_id int, manager_id int")


def _rand_ts(r, base, days):
    return base + dt.timedelta(days=r.randint(0, days), hours=r.randint(0, 23))


def _staff(r, n):
    rows = []
    for i in range(n):
        rows.append((i, f"E{i % 4}", f"T{r.randint(0, 2)}", r.choice(["Ann", "Bob"]), r.choice(["X", None]),
                     "S", "C", r.choice(["Z1", "Z2"]), "TM", r.choice(["AM1", "AM2"]), r.choice(["M1", "M2"]),
                     "Eastern", r.random() > 0.2))
    return rows


@pytest.mark.parametrize("seed", SEEDS)
def test_p5_rewrite_equals_literal_double_left_join(spark, seed):
    r = random.Random(seed)
    start, end = D(2024, 1, 1), D(2024, 1, 6)
    staff = _staff(r, 6)
    srs = []
    for _ in range(40):
        o = _rand_ts(r, T(2023, 12, 29), 10)
        c = o + dt.timedelta(days=r.randint(0, 3), hours=r.randint(0, 5)) if r.random() > 0.3 else None
        srs.append((f"E{r.randint(0, 4)}", r.randint(1, 8), o, c, 0, 0))
    acts = [(k, r.randint(0, 6), _rand_ts(r, T(2023, 12, 30), 9), r.choice(["Activity", "Time Task", "Note"]))
            for k in range(50)]
    for am, mgr in ((None, None), ("AM1", None), ("AM2", "M1")):
        for mode in ("multiply", "independent"):
            got = grid.daily_staff_summary(
                spark.createDataFrame(staff, STAFF_SCHEMA), spark.createDataFrame(srs, SRS_SCHEMA),
                spark.createDataFrame(acts, "id long, staff_id long, created_at timestamp_ntz, record_type string"),
                start, end, am, mgr, fanout=mode)
            got = Counter(tuple(x) for x in got.collect())
            # literal evaluation
            def keep(s):
                if not s[12]:
                    return False
                if am is None and mgr is None:
                    return True
                return (am is not None and s[9] == am) or (mgr is not None and s[10] == mgr)
            out = defaultdict(lambda: [0, 0, 0, 0])
            d = start
            while d <= end:
                for s in filter(keep, staff):
                    full = None if s[4] is None else f"{s[3]} {s[4]}"
                    key = (d, full, s[2], s[7], s[8])
                    out[key]  # dense
                    sr_m = [x for x in srs if x[0] == s[1] and ((x[2].date() == d) or (x[3] is not None and x[3].date() == d))]
                    pa_m = [a for a in acts if a[1] == s[0] and a[2].date() == d and a[3] in ("Activity", "Time Task")]
                    if mode == "multiply":
                        pairs = [(x, a) for x in (sr_m or [None]) for a in (pa_m or [None])]
                        for x, a in pairs:
                            out[key][0] += x is not None and x[2].date() == d
                            out[key][1] += x is not None and x[3] is not None and x[3].date() == d
                            out[key][2] += a is not None and a[3] == "Activity"
                            out[key][3] += a is not None and a[3] == "Time Task"
                    else:
                        out[key][0] += sum(x[2].date() == d for x in sr_m)
                        out[key][1] += sum(x[3] is not None and x[3].date() == d for x in sr_m)
                        out[key][2] += sum(a[3] == "Activity" for a in pa_m)
                        out[key][3] += sum(a[3] == "Time Task" for a in pa_m)
                d += dt.timedelta(days=1)
            want = Counter(k + tuple(v) for k, v in out.items())
            assert got == want, (seed, am, mgr, mode)


@pytest.mark.parametrize("seed", SEEDS)
def test_p10_equals_range_update_with_tiebreak(spark, seed):
    r = random.Random(seed)
    allocs = []
    for _ in range(25):
        s = D(2024, 1, 1) + dt.timedelta(days=r.randint(0, 20))
        e = None if r.random() < 0.1 else s + dt.timedelta(days=r.randint(-2, 8))
        allocs.append((r.randint(0, 3), r.randint(1, 9), s, e, r.random() > 0.2))
    mil = [(r.choice([0, 1, 2, 3, None]), D(2024, 1, 1) + dt.timedelta(days=r.randint(0, 30)), -1) for _ in range(60)]
    got = changes.assign_by_date_range(
        spark.createDataFrame(mil, "van_number long, mileage_date date, emp_id long"),
        spark.createDataFrame(allocs, "van_number long, emp_id long, start_date date, end_date date, is_active boolean"))
    want = []
    for v, d, emp in mil:
        m = [a for a in allocs if a[4] and v is not None and a[0] == v and a[3] is not None and a[2] <= d <= a[3]]
        if m:
            m.sort(key=lambda a: (-a[2].toordinal(), a[1]))
            emp = m[0][1]
        want.append((v, d, emp))
    assert Counter(tuple(x) for x in got.collect()) == Counter(want)


@pytest.mark.parametrize("seed", SEEDS)
def test_p2_pivot_equals_correlated_per_day(spark, seed):
    r = random.Random(seed)
    staff = [(i, f"E{i}", f"T{i}", "Ann", "L", "S", "C", "Z", "X", "AM1", "M1", "Eastern", True) for i in range(4)]
    srs = [(f"E{r.randint(0, 5)}", r.choice([None, 1, 2, 5, 6, 9]), T(2024, 4, 20),
            _rand_ts(r, T(2024, 4, 28), 12), 0, 0) for _ in range(80)]
    as_of = D(2024, 5, 6)
    got = severity.severity_pivot(spark.createDataFrame(srs, SRS_SCHEMA), spark.createDataFrame(staff, STAFF_SCHEMA), as_of)
    got = {x["tech_id"]: x.asDict() for x in got.collect()}
    days = [D(2024, 5, k) for k in range(1, 6)]
    want = {}
    for s in staff:
        mine = [x for x in srs if x[0] == s[1] and D(2024, 5, 1) <= x[3].date() <= D(2024, 5, 5)]
        if not mine:
            continue
        row = {"Total SRs": len(mine)}
        for d in days:
            c = Counter(("5+" if x[1] > 5 else str(x[1])) for x in mine if x[3].date() == d and x[1] is not None)
            row[d.isoformat()] = ", ".join(f"{c[b]} P{b}" for b in sorted(c)) or None
        want[s[2]] = row
    assert set(got) == set(want)
    for k, row in want.items():
        for col, v in row.items():
            assert got[k][col] == v, (seed, k, col)


def test_left_join_equals_left_join(spark):
    r = random.Random(7)
    left = spark.createDataFrame([(i, r.choice([None, 1, 2, 3]), r.choice([None, "a", "b"])) for i in range(60)],
                                 "id long, k1 long, k2 string")
    right = spark.createDataFrame([(1, "a", 10), (1, "a", 11), (2, "b", 20), (3, None, 30)],
                                  "r1 long, r2 string, v long")
    got = left_join(left, right, [("k1", "r1"), ("k2", "r2")])
    want = left.join(right, (left["k1"] == right["r1"]) & (left["k2"] == right["r2"]), "left")
    assert Counter(tuple(x) for x in got.collect()) == Counter(tuple(x) for x in want.select(*got.columns).collect())


def _vba_last_name(name):
    if "," in name:
        return name.split(",")[0].strip(" ")
    parts = name.split(" ")
    return parts[-1].strip(" ") if len(parts) >= 2 else name


@pytest.mark.parametrize("seed", SEEDS)
def test_p26_order_is_stable(spark, seed):
    from fieldlens.plans import mail
    r = random.Random(seed)
    names = ["Zed, A", "Amy Brown", "Brown, Al", "Cher", "Ann ", "B Brown", "Cy Zed", "Mono"]
    rows = [(r.randint(0, 3), pos, r.choice(["To", "Cc"]), r.choice(names), f"a{pos}@x") for pos in range(60)]
    df = spark.createDataFrame(rows, "message_id long, position long, type string, name string, address string")
    groups = defaultdict(list)
    for m, pos, t, name, addr in sorted(rows, key=lambda x: x[1]):
        groups[(m, t)].append((name, addr))
    stable = {(x["message_id"], x["type"]): x["sorted_addresses"] for x in mail.sorted_recipients(df).collect()}
    want_stable = {k: "; ".join(a for _, a in sorted(v, key=lambda e: _vba_last_name(e[0]))) for k, v in groups.items()}
    assert stable == want_stable


def _add_months(d, n):
    import calendar
    y, m = divmod(d.month - 1 + n, 12)
    y, m = d.year + y, m + 1
    return D(y, m, min(d.day, calendar.monthrange(y, m)[1]))


def _pg_split(s):
    if s is None:
        return None
    return [] if s == "" else s.split(",")


@pytest.mark.parametrize("seed", SEEDS)
def test_p16_p17_equal_per_project_procedure(spark, seed):
    from fieldlens.plans import projects
    r = random.Random(seed)
    months = {"monthly": 1, "quarterly": 3, "half-yearly": 6, "yearly": 12}
    vocab = ["ASIA", "EUROPE", " EUROPE", "N1", "N2", "Express", "Depot", "S1", "S9", ""]
    defs = []
    for pid in range(40):
        rec = r.choice(["one-time", "monthly", "quarterly", "half-yearly", "yearly", "weekly", None])
        scope = r.choice(["Global", "Zone", "State", "Store Type", "Specified Sites", "Nowhere", None])
        data = None if r.random() < 0.15 else ",".join(r.choice(vocab) for _ in range(r.randint(0, 3)))
        start = D(2024, 1, r.randint(1, 31))
        ci = None if r.random() < 0.5 else r.randint(1, 4)
        ce = None if ci is None else D(2024, r.randint(1, 12), r.randint(1, 28)) if r.random() < 0.7 else D(2024, 1, 31)
        defs.append((pid, rec, scope, data, start, D(2024, 12, 31), ci, None, ce))
    sites = [(f"S{i}", r.choice(["ASIA", "EUROPE", None]), r.choice(["N1", "N2"]), r.choice(["Express", "Depot", "Super"]))
             for i in range(6)]
    existing = [(r.randint(0, 39), "S1", r.randint(1, 5), "done") for _ in range(15)]
    schema = ("id long, recurrence string, scope string, scope_data string, start_date date, end_date date, "
              "cycle_index int, cycle_start_date date, cycle_end_date date")
    d_df = spark.createDataFrame(defs, schema)
    s_df = spark.createDataFrame(sites, "site string, zone string, state string, store_type string")
    e_df = spark.createDataFrame(existing, "project_id long, site string, cycle_index int, execution_status string")
    got_rows, _ = projects.project_skeleton(d_df, s_df, e_df)
    got_rows = Counter(tuple(x) for x in got_rows.collect())
    got_defs = {x["id"]: (x["cycle_index"], x["cycle_start_date"], x["cycle_end_date"])
                for x in projects.advance_definitions(d_df, e_df).collect()}
    have = {(p, c) for p, _, c, _ in existing}
    want_rows, want_defs = Counter(), {}
    for pid, rec, scope, data, start, end, ci, cs, ce in defs:
        want_defs[pid] = (ci, cs, ce)
        if rec == "one-time":
            idx, s0, e0 = 1, start, end
        elif rec in months:
            idx = (ci or 0) + 1
            s0 = (ce or start) + dt.timedelta(days=1)
            e0 = _add_months(s0, months[rec]) - dt.timedelta(days=1)
        else:
            continue  # the procedure raises
        if (pid, idx) in have:
            continue
        attr = {"Zone": 1, "State": 2, "Store Type": 3}
        if scope == "Global":
            out = [s[0] for s in sites]
        elif scope in attr:
            vals = _pg_split(data)
            out = [s[0] for s in sites if vals is not None and s[attr[scope]] is not None and s[attr[scope]] in vals]
        elif scope == "Specified Sites":
            out = _pg_split(data) or []
        else:
            continue  # the procedure raises
        for site in out:
            want_rows[(pid, site, idx, s0, e0, True, "pending")] += 1
        want_defs[pid] = (idx, s0, e0)
    assert got_rows == want_rows
    assert got_defs == want_defs


@pytest.mark.parametrize("seed", SEEDS)
def test_p19_fold_equals_sequential_procedure_calls(spark, seed):
    from fieldlens.plans import jobs
    r = random.Random(seed)
    master = [(1, "a", T(2024, 1, 1), 15, "minute", None), (2, "b", T(2024, 1, 1), 1, "hour", T(2023, 12, 1)),
              (3, "c", T(2024, 1, 1), 1, "day", None)]
    runs = []
    for seq in range(40):
        st = T(2024, 1, 1) + dt.timedelta(minutes=r.randint(0, 600))
        ended = None if r.random() < 0.2 else st + dt.timedelta(minutes=r.randint(0, 90))
        status = None if ended is None else r.choice(["SUCCESS", "FAILED"])
        runs.append((seq, r.choice(["a", "b", "c"]), st, ended, status, None))
    m_df = spark.createDataFrame(master, "id long, name string, created_at timestamp_ntz, interval_value int, "
                                         "interval_unit string, last_successful_at timestamp_ntz")
    r_df = spark.createDataFrame(runs, "event_seq long, name string, started_at timestamp_ntz, ended_at timestamp_ntz, "
                                       "status string, error_message string")
    got = {x["name"]: x.asDict() for x in jobs.apply_job_events(r_df, m_df)[1].collect()}
    secs = {"minute": 60, "hour": 3600, "day": 86400}
    state = {m[1]: {"last_run_start_at": None, "last_run_end_at": None, "last_run_status": None,
                    "last_successful_at": m[5], "next_run_at": None} for m in master}
    spec = {m[1]: m for m in master}
    events = []
    for seq, name, st, en, status, _ in runs:
        events.append((st, seq, 0, name, None))
        if en is not None:
            events.append((en, seq, 1, name, status))
    for ts, seq, kind, name, status in sorted(events):
        s = state[name]
        if kind == 0:   # start_job_run
            _, _, created, value, unit, _ = spec[name]
            span = value * secs[unit]
            k = int((ts - created).total_seconds() // span) + 1
            s.update(last_run_start_at=ts, last_run_status="RUNNING",
                     next_run_at=created + dt.timedelta(seconds=k * span))
        else:           # end_job_run
            s.update(last_run_end_at=ts, last_run_status=status)
            if status == "SUCCESS":
                s["last_successful_at"] = ts
    for name, s in state.items():
        for k, v in s.items():
            assert got[name][k] == v, (seed, name, k)


def _pg_ilike(value, pattern):
    """PostgreSQL ILIKE: % any run, _ any char, backslash makes the next char literal."""
    import re
    if value is None:
        return False
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            out.append(re.escape(pattern[i + 1]))
            i += 2
            continue
        out.append(".*" if ch == "%" else "." if ch == "_" else re.escape(ch))
        i += 1
    return re.fullmatch("".join(out), value, flags=re.IGNORECASE | re.DOTALL) is not None


@pytest.mark.parametrize("seed", SEEDS)
def test_p6_search_equals_pg_ilike(spark, seed):
    from fieldlens.plans import search
    r = random.Random(seed)
    alphabet = ["a", "B", "c", "%", "_", "\\", "1", "x"]
    def word(n):
        return "".join(r.choice(alphabet) for _ in range(n))
    hires = [(i, word(r.randint(1, 6)), "n", "p", "d", r.choice(["Open", "Hold"]), "Joined", "Z1",
              r.choice([None, 1, 2]), 9) for i in range(40)]
    emps = [(1, word(4), None), (2, word(3), word(2)), (9, "Boss", "Man")]
    h_df = spark.createDataFrame(hires, "id long, req_num string, name string, position string, department string, "
                                        "req_status string, hire_status string, zone string, old_emp_id long, manager_id long")
    e_df = spark.createDataFrame(emps, "id long, first_name string, last_name string")
    for _ in range(6):
        terms = [word(r.randint(0, 3)) for _ in range(r.randint(1, 3))]
        text = " ".join(terms)
        if not text:
            continue
        got = sorted(x["emp_id"] for x in search.search_hires(h_df, e_df, text, pos_status="Open").collect())
        emp = {e[0]: e for e in emps}
        want = []
        for h in hires:
            e = emp.get(h[8])
            if h[5] != "Open":
                continue
            if any(_pg_ilike(v, f"%{t}%") for t in text.split(" ")
                   for v in (h[1], e and e[1], e and e[2])):
                want.append(h[0])
        assert got == sorted(want), (seed, text)


def test_local_to_utc_every_half_hour_of_2024(spark):
    """Every wall time of 2024 (30-minute steps) in each mapped zone, against
    zoneinfo under PostgreSQL's reading: an ambiguous time is standard time,
    a skipped time takes the offset in force before the jump."""
    from zoneinfo import ZoneInfo
    from pyspark.sql import functions as F
    from fieldlens.functions.dates import ZONE_NAMES, iso_utc_text, local_to_utc, zone_name
    utc = dt.timezone.utc
    rows, want = [], {}
    start = T(2024, 1, 1)
    for label, zname in list(ZONE_NAMES.items()) + [("Other", "UTC")]:
        z = ZoneInfo(zname)
        for k in range(366 * 48):
            wall = start + dt.timedelta(minutes=30 * k)
            a, b = wall.replace(tzinfo=z, fold=0), wall.replace(tzinfo=z, fold=1)
            trips = [x for x in (a, b) if x.astimezone(utc).astimezone(z).replace(tzinfo=None) == wall]
            if len(trips) == 2 and a.utcoffset() != b.utcoffset():
                u = max(trips, key=lambda x: x.astimezone(utc))      # ambiguous: the later instant
            elif trips:
                u = trips[0]
            else:
                u = a                                                  # skipped: offset before the jump
            want[(label, wall)] = u.astimezone(utc).strftime("%Y-%m-%dT%H:%M:%SZ")
            rows.append((label, wall))
    df = spark.createDataFrame(rows, "label string, wall timestamp_ntz")
    got = df.select("label", "wall", iso_utc_text(local_to_utc(F.col("wall"), zone_name(F.col("label")))).alias("u"))
    bad = [(r["label"], r["wall"], r["u"], want[(r["label"], r["wall"])]) for r in got.collect()
           if r["u"] != want[(r["label"], r["wall"])]]
    assert not bad, bad[:5]


@pytest.mark.parametrize("seed", SEEDS)
def test_p21_equals_set_based_compare(spark, seed):
    from fieldlens.plans import quality
    r = random.Random(seed)
    def catalog():
        out = []
        for t in ("t1", "t2", "t3"):
            if r.random() < 0.2:
                continue
            for c in ("a", "b", "c", "d"):
                if r.random() < 0.3:
                    continue
                out.append((t, c, 1, r.choice(["int4", "int8", "text"]), r.choice([None, 0, 50]),
                            r.choice(["YES", "NO"]), r.choice([None, "", "now()"])))
        return out
    src_rows, tgt_rows = catalog(), catalog()
    schema = ("table_name string, column_name string, ordinal_position int, data_type string, max_length int, "
              "is_nullable string, column_default string")
    got = {(x["table"], x["column"]): (x["change"], x["sql_query"]) for x in
           quality.schema_diff_columns(spark.createDataFrame(src_rows, schema),
                                       spark.createDataFrame(tgt_rows, schema)).collect()}
    src = {(x[0], x[1]): (x[3], x[4], x[5], x[6]) for x in src_rows}
    tgt = {(x[0], x[1]): (x[3], x[4], x[5], x[6]) for x in tgt_rows}
    both_tables = {t for t, _ in src} & {t for t, _ in tgt}
    want = {}
    for (t, c), (dtype, mlen, nul, dflt) in src.items():
        if t not in both_tables:
            continue
        typ = dtype + (f"({mlen})" if mlen else "")
        if (t, c) not in tgt:
            sql = f"ALTER TABLE public.{t} ADD COLUMN {c} {typ}" + (" NOT NULL" if nul.lower() == "no" else " NULL") \
                  + (f" DEFAULT {dflt}" if dflt else "") + ";"
            want[(t, c)] = ("added", sql)
        elif (dtype, mlen, nul, dflt) != tgt[(t, c)]:
            tdtype, tmlen, tnul, tdflt = tgt[(t, c)]
            acts = []
            if dtype != tdtype or mlen != tmlen:
                acts.append(f"ALTER COLUMN {c} TYPE {typ}")
            if nul != tnul:
                acts.append(f"ALTER COLUMN {c} " + ("SET NOT NULL" if nul.lower() == "no" else "DROP NOT NULL"))
            if dflt != tdflt:
                acts.append(f"ALTER COLUMN {c} " + (f"SET DEFAULT {dflt}" if dflt is not None else "DROP DEFAULT"))
            want[(t, c)] = ("modified", f"ALTER TABLE public.{t} " + ", ".join(acts) + ";")
    for (t, c) in tgt:
        if t in both_tables and (t, c) not in src:
            want[(t, c)] = ("removed", f"ALTER TABLE public.{t} DROP COLUMN {c};")
    assert got == want
