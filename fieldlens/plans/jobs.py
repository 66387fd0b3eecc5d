"""Job-run ledger: P18 run slots, P19 log and master post-images.

The reference records one run per procedure call.  Here a table of runs
(one row per run: job name, start, and optionally end, end status and
error) is folded in one pass, and ends of runs that an earlier log holds come
by log id.  Per-job state is a grouped ``max_by`` over a total event order -- a
declarative aggregate with map-side partial aggregation, so a job with a third
of all runs costs one partial row per task.  A caller that knows the job master
to be small passes it as ``F.broadcast(job_master)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import add_units, span_us, unit_months, unit_us
from ..operators.joins import left_join

MASTER_STATE = ["last_run_start_at", "last_run_end_at", "last_run_status", "last_successful_at", "next_run_at"]


def run_outcomes(runs: DataFrame, job_master: DataFrame, seq_col: str = "event_seq") -> DataFrame:
    """Every run once, with its slot (job_id, run_count, log_id, scheduled_for,
    next_run_at) and a NULL ``reason``, or without one and with the reason why:
    the job is unknown, or its interval unit is none that PostgreSQL reads.
    Accepted and rejected runs come from one pass; ``sinks.outcomes`` stores them so."""
    m = job_master.select(F.col("id").alias("job_id"), F.col("name").alias("__name"),
                          "created_at", "interval_value", "interval_unit",
                          *[worth(F.col("interval_unit")).alias(c) for c, worth in
                            (("__span", span_us), ("__months", unit_months), ("__us", unit_us))])
    all_runs = runs.join(m, runs["name"] == m["__name"], "left")
    reason = (F.when(F.col("__name").isNull(), F.concat(F.lit("Job not found: "), F.coalesce(F.col("name"), F.lit("NULL"))))
              .when(F.col("__span").isNull(), F.concat(F.lit("invalid interval unit: "),
                                               F.coalesce(F.col("interval_unit"), F.lit("NULL")))))
    value, months, us = F.col("interval_value").cast("long"), F.col("__months"), F.col("__us")
    elapsed_us = F.timestamp_diff("MICROSECOND", F.col("created_at"), F.col("started_at"))
    run_count = F.when(F.col("__span").isNotNull(), (F.floor(elapsed_us / (value * F.col("__span"))) + 1).cast("long"))
    return (all_runs.withColumn("reason", reason).withColumn("run_count", run_count)
            .withColumn("log_id", F.concat(F.col("job_id").cast("string"), F.lit(":"), F.col(seq_col).cast("string")))
            .withColumn("scheduled_for", add_units(F.col("created_at"), (F.col("run_count") - 1) * value, months, us))
            .withColumn("next_run_at", add_units(F.col("created_at"), F.col("run_count") * value, months, us))
            .drop("__name", "__span", "__months", "__us"))


def slotted_runs(runs: DataFrame, job_master: DataFrame, seq_col: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """The accepted ``run_outcomes`` (run columns kept), and the rejected runs
    with a ``reason``.  ``strict=True`` fails the job on a reject."""
    every = run_outcomes(runs, job_master, seq_col)
    rejects = every.where("reason IS NOT NULL").select(*runs.columns, "reason")
    # strict: the check is the only filter, so that no other one can run before it
    good = F.when(F.col("reason").isNotNull(), F.raise_error(F.col("reason"))).isNull() if strict else F.col("reason").isNull()
    return every.where(good).drop("reason"), rejects


def job_slots(runs: DataFrame, job_master: DataFrame, seq_col: str = "event_seq",
              strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """For each run start, its slot since job creation.

    ``run_count = floor(elapsed / interval) + 1`` where both spans are in
    seconds and a month counts 30 days, a year 365.25 days; then
    ``scheduled_for = created_at + (run_count - 1) * interval`` and
    ``next_run_at = created_at + run_count * interval`` with calendar
    months.  A start before creation gets a slot <= 0 (floor, not
    truncation).  Returns ``(log_rows, rejects)``, see :func:`slotted_runs`.
    """
    s, rejects = slotted_runs(runs, job_master, seq_col, strict=strict)
    return s.select("log_id", "job_id", "name", seq_col, "run_count", "scheduled_for",
                    F.lit("RUNNING").alias("status"), "started_at", "next_run_at"), rejects


def apply_job_events(runs: DataFrame, job_master: DataFrame,
                     seq_col: str = "event_seq") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fold run starts and ends into the log and master post-images.

    A run row carries its own end (``ended_at``, ``status``,
    ``error_message``); without ``ended_at`` it is still running.  Events
    are ordered by (time, sequence, start-before-end).  Per job: last
    start and its ``next_run_at``, last end, status of the latest event
    (``RUNNING`` for a start), and the end time of the latest ``SUCCESS``
    (else the previous value).  Returns ``(log, master, rejects)``.
    """
    s, rejects = slotted_runs(runs, job_master, seq_col)
    ended = F.col("ended_at").isNotNull()
    log = s.select("log_id", "job_id", "scheduled_for",
                   F.when(ended, F.col("status")).otherwise(F.lit("RUNNING")).alias("status"),
                   "started_at", "ended_at", "error_message")
    return log, master_post_image(job_master, job_state(s, seq_col)), rejects


def end_job_runs(job_log: DataFrame, job_master: DataFrame,
                 ends: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """P19 for runs that an earlier log holds: ``ends`` has ``log_id, status,
    ended_at, error_message``.

    The log row of that id gets the three values, NULL included; of several
    ends of one id the latest counts (then the largest status).  Per job of an
    ended run: the end and status of its latest end, and the end of its latest
    ``SUCCESS`` (else the previous value).  Returns ``(log, master, rejects)``;
    rejects are ends whose log id is unknown.
    """
    last = (ends.groupBy(F.col("log_id").alias("__log"))
            .agg(F.max_by(F.struct("status", "ended_at", "error_message"),
                          F.struct("ended_at", "status", "error_message")).alias("__end")))
    joined = left_join(job_log, last, [("log_id", "__log")])
    ended = F.col("__log").isNotNull()
    log = joined.select(*[F.when(ended, F.col(f"__end.{c}")).otherwise(F.col(c)).alias(c)
                          if c in ("status", "ended_at", "error_message") else F.col(c) for c in job_log.columns])
    order = F.struct("__end.ended_at", "log_id")
    ok = F.col("__end.status") == "SUCCESS"
    state = (joined.where(ended).groupBy(F.col("job_id").alias("__job"))
             .agg(F.max_by("__end.ended_at", order).alias("n_last_run_end_at"),
                  F.max_by("__end.status", order).alias("n_last_run_status"),
                  F.max_by("__end.ended_at", F.when(ok, order)).alias("n_last_successful_at"))
             .withColumns({"had_start": F.lit(False), "had_end": F.lit(True),
                           "n_last_run_start_at": F.lit(None).cast("timestamp_ntz"),
                           "n_next_run_at": F.lit(None).cast("timestamp_ntz")}))
    known = job_log.select(F.col("log_id").alias("__known")).distinct()
    rejects = ends.join(known, ends["log_id"] == known["__known"], "left_anti")
    return log, master_post_image(job_master, state), rejects


def job_state(slotted: DataFrame, seq_col: str = "event_seq") -> DataFrame:
    """Per-job state from slotted runs (batch or streaming): last start and
    its next_run_at, last end, latest status, latest success."""
    events = slotted.select("job_id", F.explode(F.array(
        F.struct(F.col("started_at").alias("ts"), F.col(seq_col).alias("seq"), F.lit(0).alias("kind"),
                 F.lit("RUNNING").alias("ev_status"), F.col("next_run_at").alias("nra")),
        F.struct(F.col("ended_at").alias("ts"), F.col(seq_col).alias("seq"), F.lit(1).alias("kind"),
                 F.col("status").alias("ev_status"), F.lit(None).cast("timestamp_ntz").alias("nra")),
    )).alias("e")).where(F.col("e.ts").isNotNull())
    order = F.struct("e.ts", "e.seq", "e.kind")
    is_start, is_end = F.col("e.kind") == 0, F.col("e.kind") == 1
    ok = is_end & (F.col("e.ev_status") == "SUCCESS")
    return events.groupBy(F.col("job_id").alias("__job")).agg(
        F.max_by("e.ts", F.when(is_start, order)).alias("n_last_run_start_at"),
        F.max_by("e.nra", F.when(is_start, order)).alias("n_next_run_at"),
        F.max_by("e.ts", F.when(is_end, order)).alias("n_last_run_end_at"),
        F.max_by("e.ev_status", order).alias("n_last_run_status"),
        F.max_by("e.ts", F.when(ok, order)).alias("n_last_successful_at"),
        F.max(is_start).alias("had_start"), F.max(is_end).alias("had_end"),
    )


def master_post_image(job_master: DataFrame, state: DataFrame) -> DataFrame:
    """Job master with the folded state applied (jobs without events unchanged).
    What an event sets is set even to NULL: a start sets the start and the next
    run, an end sets the end, either sets the status."""
    base = job_master
    for c in MASTER_STATE:
        if c not in base.columns:
            base = base.withColumn(c, F.lit(None).cast("string" if c == "last_run_status" else "timestamp_ntz"))
    jm = base.join(state, base["id"] == state["__job"], "left")  # one state row per job
    start, end = F.coalesce("had_start", F.lit(False)), F.coalesce("had_end", F.lit(False))
    sets = {"last_run_start_at": start, "next_run_at": start, "last_run_end_at": end, "last_run_status": start | end,
            "last_successful_at": F.col("n_last_successful_at").isNotNull()}
    return jm.select(*[F.when(sets[c], F.col(f"n_{c}")).otherwise(base[c]).alias(c) if c in sets else base[c]
                       for c in base.columns])
