"""Structured Streaming versions of the reference's event-driven pipelines.

The reference's job-run procedures are called once per run start/end;
``job_ledger`` folds a stream of run rows into per-job state with a
streaming aggregation (state store, exactly-once checkpointing).  Nothing
else in the reference is a stream.
"""
