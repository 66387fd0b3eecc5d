"""The streaming job ledger folds to the same master post-image as the batch pipeline."""
import datetime as dt
import tempfile

from fieldlens.plans import jobs
from fieldlens.streaming.job_ledger import RUN_SCHEMA, start_job_ledger

T = dt.datetime


def test_stream_matches_batch(spark):
    master = spark.createDataFrame([(1, "a", T(2024, 1, 1), 15, "minute"), (2, "b", T(2024, 1, 1), 1, "hour")],
                                   "id long, name string, created_at timestamp_ntz, interval_value int, interval_unit string")
    batches = [
        [(1, "a", T(2024, 1, 1, 0, 20), T(2024, 1, 1, 0, 21), "SUCCESS", None),
         (2, "b", T(2024, 1, 1, 3, 5), None, None, None)],
        [(3, "a", T(2024, 1, 1, 0, 50), T(2024, 1, 1, 0, 52), "FAILED", "x"),
         (4, "b", T(2024, 1, 1, 1, 0), T(2024, 1, 1, 1, 2), "SUCCESS", None)],
    ]
    src = tempfile.mkdtemp(prefix="ledger-src-")
    out = tempfile.mkdtemp(prefix="ledger-out-") + "/master"
    ckpt = tempfile.mkdtemp(prefix="ledger-ckpt-")
    runs = spark.readStream.schema(RUN_SCHEMA).parquet(src)
    q = start_job_ledger(spark, runs, master, out, checkpoint_location=ckpt)
    try:
        for i, b in enumerate(batches):
            spark.createDataFrame(b, RUN_SCHEMA).write.mode("append").parquet(src)
            q.processAllAvailable()
    finally:
        q.stop()
    streamed = {r["name"]: tuple(r) for r in spark.read.parquet(out).collect()}
    all_runs = spark.createDataFrame([r for b in batches for r in b], RUN_SCHEMA)
    batch = {r["name"]: tuple(r) for r in jobs.apply_job_events(all_runs, master)[1].collect()}
    assert streamed == batch
    assert streamed["a"][7] == "FAILED" and streamed["b"][7] == "RUNNING"


def test_stream_restarts_from_its_checkpoint(spark):
    master = spark.createDataFrame([(1, "a", T(2024, 1, 1), 1, "hour")],
                                   "id long, name string, created_at timestamp_ntz, interval_value int, interval_unit string")
    b1 = [(1, "a", T(2024, 1, 1, 1), T(2024, 1, 1, 2), "SUCCESS", None)]
    b2 = [(2, "a", T(2024, 1, 1, 3), T(2024, 1, 1, 4), "FAILED", "x")]
    src = tempfile.mkdtemp(prefix="ledger-src-")
    out = tempfile.mkdtemp(prefix="ledger-out-") + "/master"
    ckpt = tempfile.mkdtemp(prefix="ledger-ckpt-")
    runs = spark.readStream.schema(RUN_SCHEMA).parquet(src)
    spark.createDataFrame(b1, RUN_SCHEMA).write.mode("append").parquet(src)
    q = start_job_ledger(spark, runs, master, out, checkpoint_location=ckpt)
    q.processAllAvailable()
    q.stop()                                   # the driver goes away; state lives in the checkpoint
    spark.createDataFrame(b2, RUN_SCHEMA).write.mode("append").parquet(src)
    q = start_job_ledger(spark, spark.readStream.schema(RUN_SCHEMA).parquet(src), master, out, checkpoint_location=ckpt)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    row = spark.read.parquet(out).first()
    assert row["last_run_status"] == "FAILED"
    assert row["last_successful_at"] == T(2024, 1, 1, 2)   # from the batch before the restart
    assert row["next_run_at"] == T(2024, 1, 1, 4)
