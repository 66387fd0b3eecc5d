"""Month-to-date reports that are kept up to date: P1, P2, P4 and P24 from a
stored state of counts, changed by signed deltas.

A batch of changed SRs comes as two images: what the rows were (none for new
ones) and what they are (none for deleted ones).  Each row of the new image adds
one to its group, each of the old image takes one away; groups that come out
even are dropped.  The sums are all that the reports need, so late closes,
reopened SRs, corrected severities and deletions are just deltas.

A batch's deltas are files of their own, in folders by month and batch.  Adding a
batch reads the batch alone, not the state, and writing a batch again replaces
its folders, so a batch that was cut off is run again.  A report reads the
folders of its months and sums.  ``compact`` folds the deltas of many batches into
one.  The state has one row per staff member, day and bucket (and, for trends,
per pair of days), whatever the number of SRs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_bucket, month_to_yesterday, ts_literal
from ..functions.text import severity_bucket
from .severity import MAX_SEVERITY

CLOSED = "siebel_id string, closed_day date, bucket string, n bigint, month date, batch int"
_MIDNIGHT = "open_at_midnight boolean, closed_at_midnight boolean"
TREND = ("open_day date, closed_day date, " + _MIDNIGHT + ", severity int, assoc_manager_id int, manager_id int, n bigint, "
         "month date, batch int")


def _signed(old: DataFrame | None, new: DataFrame | None, pick) -> DataFrame:
    images = [pick(df).withColumn("sign", F.lit(s)) for df, s in ((new, 1), (old, -1)) if df is not None]
    if not images:
        raise ValueError("a batch has an old image, a new one or both")
    both = images[0] if len(images) == 1 else images[0].unionByName(images[1])
    groups = [c for c in both.columns if c != "sign"]
    return both.groupBy(*groups).agg(F.sum("sign").cast("long").alias("n")).where("n <> 0")


def closed_deltas(old: DataFrame | None, new: DataFrame | None) -> DataFrame:
    """(siebel_id, closed_day, bucket, n): how a batch changes ``closed_counts``.
    SRs that are open in an image count for nothing there."""
    return _signed(old, new, lambda df: df.where("closed_date IS NOT NULL").select(
        "siebel_id", F.to_date("closed_date").alias("closed_day"), severity_bucket("severity").alias("bucket")))


def trend_deltas(old: DataFrame | None, new: DataFrame | None) -> DataFrame:
    """The same for ``severity_trend``: per pair of days, with whether the times
    are midnights (P4 compares its last day with midnight)."""
    def midnight(c: str) -> Column:
        return F.col(c) == F.to_date(c).cast("timestamp_ntz")

    days = F.struct(F.to_date("open_date").alias("o"), F.to_date("closed_date").alias("c"))
    return _signed(old, new, lambda df: df.withColumn("days", days).where("days.o IS NOT NULL OR days.c IS NOT NULL").select(
        F.col("days.o").alias("open_day"), F.col("days.c").alias("closed_day"),
        midnight("open_date").alias("open_at_midnight"), midnight("closed_date").alias("closed_at_midnight"),
        "severity", "assoc_manager_id", "manager_id"))


def add_batch(deltas: DataFrame, path: str, batch: int) -> None:
    """Store a batch's deltas (closed or trend).  The batch's number is the
    caller's; a batch written again replaces itself, and months that it no
    longer has have to be the same, as they are when its images are."""
    day = F.coalesce("open_day", "closed_day") if "open_day" in deltas.columns else F.col("closed_day")
    (deltas.withColumns({"month": F.trunc(day, "month"), "batch": F.lit(batch)}).hint("rebalance", F.col("month"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", "batch").parquet(path))


def closed_counts(spark: SparkSession, path: str, as_of) -> DataFrame:
    """The ``counts`` that P1, P2 and P24 take, of ``as_of``'s month to the day
    before: only this month's folders are read."""
    start, end = month_to_yesterday(as_of)
    state = spark.read.schema(CLOSED).parquet(path)
    days = F.col("closed_day").between(F.lit(start), F.lit(end)) if start <= end else F.lit(False)
    days = days & (F.col("month") == F.lit(start.replace(day=1)))
    return state.where(days).groupBy("siebel_id", "closed_day", "bucket").agg(F.sum("n").cast("long").alias("n")).where("n <> 0")


def severity_trend(spark: SparkSession, path: str, start, end, assoc_mgr_id=None, manager_id=None,
                   level: str | None = "daily") -> DataFrame:
    """P4 from the stored trend state.  An SR's folder is that of the month in
    which it opened (closed, if it has no open day), so what was opened in later
    months than ``end`` is not read."""
    lo, hi = F.to_date(ts_literal(start)), F.to_date(ts_literal(end))
    state = spark.read.schema(TREND).parquet(path).where(F.col("month") <= hi)
    # Bounds are midnights: on the last day only midnight itself is inside.
    inside = lambda day, midnight: (F.col(day) >= lo) & ((F.col(day) < hi) | ((F.col(day) == hi) & F.col(midnight)))
    for c, v in (("assoc_manager_id", assoc_mgr_id), ("manager_id", manager_id)):
        state = state if v is None else state.where(F.col(c) == v)
    opened, closed = inside("open_day", "open_at_midnight"), inside("closed_day", "closed_at_midnight")
    rows = state.where(opened | closed).select(
        "severity", "n", opened.alias("open"), closed.alias("close"),
        date_bucket(F.coalesce("open_day", "closed_day").cast("timestamp_ntz"), level).alias("aggregation_date"))
    counts = [F.expr(f"coalesce(sum(CASE WHEN severity = {k} AND {side} THEN n END), 0L)").alias(f"{side}_sev{k}")
              for side in ("open", "close") for k in range(1, MAX_SEVERITY + 1)]
    return rows.groupBy("aggregation_date").agg(F.sum("n").alias("n"), *counts).where("n <> 0").drop("n")


def compact(spark: SparkSession, path: str, to: str, schema: str) -> None:
    """Fold all batches of a state into one, batch 0 of a new folder ``to``."""
    state = spark.read.schema(schema).parquet(path).drop("month", "batch")
    groups = [c for c in state.columns if c != "n"]
    add_batch(state.groupBy(*groups).agg(F.sum("n").cast("long").alias("n")).where("n <> 0"), to, 0)
