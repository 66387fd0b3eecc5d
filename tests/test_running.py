"""Reports from merged states equal those over everything."""
import datetime as dt
import glob
import os
import random

import pytest

from fieldlens.plans import running, severity

SR = ("sr_id long, siebel_id string, severity int, open_date timestamp_ntz, closed_date timestamp_ntz, "
      "assoc_manager_id int, manager_id int")
AS_OF = dt.date(2024, 3, 20)


def sr(rng, i):
    opened = dt.datetime(2024, rng.choice([2, 3]), rng.randint(1, 28), rng.choice([0, 0, 9]), 0)
    closed = rng.choice([None, opened + dt.timedelta(days=rng.randint(0, 20), hours=rng.choice([0, 5]))])
    return [i, f"E{rng.randint(0, 5)}", rng.choice([None, 1, 2, 6, 15, 16]), rng.choice([opened, opened, None]), closed, rng.randint(0, 2), rng.randint(0, 1)]


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    """Three batches: new SRs, corrections with late closes, deletions with more new ones."""
    rng = random.Random(11)
    path = str(tmp_path_factory.mktemp("state"))
    now = {i: sr(rng, i) for i in range(150)}
    batches = [([], list(map(list, now.values())))]
    changed = rng.sample(sorted(now), 60)
    old = [list(now[i]) for i in changed]
    for i in changed:
        now[i] = sr(rng, i)
    batches.append((old, [list(now[i]) for i in changed]))
    gone = rng.sample(sorted(now), 30)
    old = [list(now.pop(i)) for i in gone]
    fresh = [sr(rng, i) for i in range(200, 240)]
    now |= {r[0]: r for r in fresh}
    batches.append((old, fresh))
    frame = lambda rows: spark.createDataFrame(rows, SR)
    for k, (a, b) in enumerate(batches):
        for _ in range(2 if k == 1 else 1):  # a batch that is run again counts once
            running.add_batch(running.closed_deltas(frame(a), frame(b)), f"{path}/closed", k)
            running.add_batch(running.trend_deltas(frame(a) if a else None, frame(b)), f"{path}/trend", k)
    staff = spark.createDataFrame([(f"E{i}", f"T{i % 4}", "Ann", "S", "C", "Z", "Team", "AM", "M") for i in range(6)],
                                  "emp_id string, tech_id string, first_name string, state string, city string, zone string, team string, "
                                  "assoc_manager_tid string, manager_tid string")
    return path, frame(list(now.values())), staff


def bag(df):
    return sorted(map(str, df.collect()))


def test_reports_equal_those_over_everything(spark, history):
    path, srs, staff = history
    for as_of in (AS_OF, dt.date(2024, 3, 1), dt.date(2024, 2, 29)):
        counts = running.closed_counts(spark, f"{path}/closed", as_of)
        for report in (severity.severity_summary, severity.severity_pivot):
            assert bag(report(None, staff, as_of, counts=counts)) == bag(report(srs, staff, as_of))


@pytest.mark.parametrize("level,am,mgr", [("daily", None, None), ("weekly", 1, None), ("monthly", None, 1)])
def test_trends_equal_those_over_everything(spark, history, level, am, mgr):
    path, srs, _ = history
    for start, end in ((dt.date(2024, 2, 10), dt.date(2024, 3, 10)), (dt.date(2024, 3, 1), dt.date(2024, 3, 31))):
        assert bag(running.severity_trend(spark, f"{path}/trend", start, end, am, mgr, level)) == bag(
            severity.severity_trend(srs, start, end, am, mgr, level))


def test_a_compacted_state_gives_the_same(spark, history, tmp_path):
    path, srs, staff = history
    running.compact(spark, f"{path}/closed", f"{tmp_path}/one", running.CLOSED)
    assert {os.path.basename(d) for d in glob.glob(f"{tmp_path}/one/*/batch=*")} == {"batch=0"}
    counts = running.closed_counts(spark, f"{tmp_path}/one", AS_OF)
    assert bag(severity.severity_summary(None, staff, AS_OF, counts=counts)) == bag(severity.severity_summary(srs, staff, AS_OF))


def test_only_the_month_of_the_report_is_read(spark, history):
    path, *_ = history
    plan = running.closed_counts(spark, f"{path}/closed", AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "2024-03-01" in plan
    files = glob.glob(f"{path}/closed/month=2024-02*/*/*.parquet")
    assert files
    for f in files:  # what is not read may be anything
        open(f, "wb").write(b"broken")
        os.remove(os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc"))
    assert running.closed_counts(spark, f"{path}/closed", AS_OF).count() > 0


def test_a_batch_without_images(spark):
    with pytest.raises(ValueError):
        running.closed_deltas(None, None)
