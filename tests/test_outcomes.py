"""One pass for accepted rows, rejects and counts."""
import datetime as dt

from pyspark.sql import functions as F

from fieldlens.plans import jobs
from fieldlens.sinks import outcomes

T = dt.datetime


def tables(spark, n=200):
    names = ["a", "b", "c", None]
    runs = spark.createDataFrame([(i, names[i % 4], T(2024, 1, 1 + i % 28, 3), i) for i in range(n)],
                                 "event_seq long, name string, started_at timestamp_ntz, outcome long")
    master = spark.createDataFrame([(1, "a", T(2024, 1, 1), 2, "hours"), (2, "b", T(2024, 1, 1), 1, "fortnight")],
                                   "id long, name string, created_at timestamp_ntz, interval_value int, interval_unit string")
    return runs, master


def test_tables_and_counts_agree(spark, tmp_path):
    runs, master = tables(spark)
    every = jobs.run_outcomes(runs, master)
    for _ in range(2):  # again: the same
        counts = outcomes.write_outcomes(every, f"{tmp_path}/o")
        assert counts == {"accepted": 50, "rejected": 150}
        good, bad = (outcomes.read_outcomes(spark, f"{tmp_path}/o", every, k) for k in counts)
        slots, rejects = jobs.job_slots(runs, master)
        assert sorted(map(tuple, good.select("log_id", "run_count", "scheduled_for", "next_run_at", "outcome").collect())) == sorted(
            map(tuple, slots.join(runs.select("event_seq", "outcome"), "event_seq").select(
                "log_id", "run_count", "scheduled_for", "next_run_at", "outcome").collect()))
        assert sorted(map(str, bad.select(*runs.columns, "reason").collect())) == sorted(map(str, rejects.collect()))
        assert set(r["reason"] for r in bad.select("reason").distinct().collect()) == {
            "Job not found: c", "Job not found: NULL", "invalid interval unit: fortnight"}


def test_the_runs_are_scanned_once(spark, tmp_path):
    runs, master = tables(spark)
    runs.write.parquet(f"{tmp_path}/runs")
    stored = spark.read.schema(runs.schema).parquet(f"{tmp_path}/runs")
    plan = jobs.run_outcomes(stored, F.broadcast(master))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_no_rows(spark, tmp_path):
    runs, master = tables(spark)
    every = jobs.run_outcomes(runs.limit(0), master)
    assert outcomes.write_outcomes(every, f"{tmp_path}/o") == {"accepted": 0, "rejected": 0}
