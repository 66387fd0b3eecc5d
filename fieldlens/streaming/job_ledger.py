"""P19 over a stream: per-job run state from a stream of run rows.

Run rows (``event_seq, name, started_at, ended_at, status,
error_message``) arrive from any streaming source.  The job master is a
static dimension (stream-static join).
Per-job state is the same ``max_by`` fold as the batch pipeline, kept in
the state store; the state has one row per job, so ``complete`` output
is bounded by the job master.  Each micro-batch writes the master
post-image with an idempotent overwrite, so a replayed batch after an
executor or driver loss rewrites the same result.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.jobs import job_state, master_post_image, slotted_runs

RUN_SCHEMA = ("event_seq long, name string, started_at timestamp_ntz, ended_at timestamp_ntz, "
              "status string, error_message string")


def job_state_stream(runs: DataFrame, job_master: DataFrame, seq_col: str = "event_seq") -> DataFrame:
    """Streaming per-job state (columns ``__job`` and ``n_*``) from a streaming run DataFrame."""
    slotted, _ = slotted_runs(runs, job_master, seq_col)
    return job_state(slotted, seq_col)


def _checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir (a shared folder) or pass checkpoint_location")
    return root


def start_job_ledger(spark: SparkSession, runs: DataFrame, job_master: DataFrame, output_path: str,
                     checkpoint_location: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Start the streaming fold; each micro-batch overwrites ``output_path``
    with the job master post-image."""
    state = job_state_stream(runs, job_master)
    location = checkpoint_location or os.path.join(_checkpoint_root(spark), "job_ledger")

    def write_post_image(batch: DataFrame, batch_id: int) -> None:
        master_post_image(job_master, batch).write.mode("overwrite").parquet(output_path)

    writer = (state.writeStream.outputMode("complete").option("checkpointLocation", location)
              .foreachBatch(write_post_image))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
