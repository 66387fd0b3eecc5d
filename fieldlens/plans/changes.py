"""Change capture and post-image updates: P8 staff history, P9 staging
apply, P10 date-range assignment of mileage to allocations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import ts_literal
from ..operators.digests import narrowed
from ..operators.joins import expand_days, left_join
from ..operators.ranges import as_number, with_winner
from ..operators.updates import apply_by_key, one_per_key
from ..sinks.tables import KeyedTable

TRACKED = ("zone", "team", "title")
# staging column -> master column
STAGING_TO_MASTER = {"zone": "zone", "team": "team", "title": "title",
                     "firstname": "first_name", "lastname": "last_name", "mobile": "mobile"}


def staff_change_history(master: DataFrame, staging: DataFrame, change_ts) -> DataFrame:
    """One history row per (master, staging) match whose zone, team or
    title differ (a NULL on either side is not a difference).  The row
    carries the master's current values, ``change_date`` and a JSON
    comment ``{"changes": {"zone": {"old", "new"}, "team": ..., "title": ...}}``."""
    m = master.alias("sm")
    s = staging.alias("ss")
    j = m.join(s, F.col("sm.emp_id") == F.col("ss.emp_id"))
    differs = None
    for c in TRACKED:
        d = F.col(f"sm.{c}") != F.col(f"ss.{c}")
        differs = d if differs is None else differs | d
    changes = F.struct(*[F.struct(F.col(f"sm.{c}").alias("old"), F.col(f"ss.{c}").alias("new")).alias(c)
                         for c in TRACKED])
    comments = F.to_json(F.struct(changes.alias("changes")), {"ignoreNullFields": "false"})
    return j.where(differs).select(
        F.col("sm.emp_id").alias("emp_id"), F.col("sm.zone").alias("zone"), F.col("sm.team").alias("team"),
        F.col("sm.title").alias("title"), F.col("sm.first_name").alias("firstname"),
        F.col("sm.last_name").alias("lastname"), F.col("sm.mobile").alias("mobile"),
        ts_literal(change_ts).alias("change_date"), comments.alias("comments"))


def staff_change_history_by_digest(master: DataFrame, staging: DataFrame, change_ts) -> DataFrame:
    """P8 where little changes: rows of buckets whose checksums are equal on both
    sides are not joined (``operators.digests``).  The key has to be unique in one
    of the tables; repeated rows of the other are as in P8."""
    a, b = narrowed(master, staging, ["emp_id"], list(TRACKED))
    return staff_change_history(a, b, change_ts)


def apply_staging(master: DataFrame, staging: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Master post-image with zone, team, title, names and mobile taken
    from staging for every matching ``emp_id`` (changed or not, NULL
    overwrites).  Of several different staging rows of one key, the one that is
    largest over its columns in order is applied; such keys are reported.
    Returns ``(post_image, reported keys with their number of rows)``."""
    one, several = one_per_key(staging.select("emp_id", *STAGING_TO_MASTER), ["emp_id"])
    set_cols = {tgt: src for src, tgt in STAGING_TO_MASTER.items()}
    return apply_by_key(master, one, ["emp_id"], set_cols), several


def update_stored_master(table: KeyedTable, staging: DataFrame) -> list[int]:
    """P9 on a stored master keyed by ``emp_id``: only partitions in which a row
    changes are rewritten; their numbers are returned."""
    set_cols = {tgt: src for src, tgt in STAGING_TO_MASTER.items()}
    return table.update(staging.select("emp_id", *STAGING_TO_MASTER), set_cols)


def assign_by_date_range(mileage: DataFrame, allocations: DataFrame, active_only: bool = True) -> DataFrame:
    """P10: mileage post-image where ``emp_id`` comes from the allocation of
    the same van whose ``[start_date, end_date]`` holds ``mileage_date``.
    Rows without such an allocation keep their ``emp_id``; an open-ended
    allocation (NULL end) matches nothing.  Overlapping allocations: the
    latest start wins, then the lowest emp_id.

    Allocations are cut to the first and last mileage day, expanded to one row
    per covered day and reduced to one winner per (van, day), so the join is an
    exact equi-join with at most one partner per mileage row, and an allocation
    that ends in the year 9999 costs no more than the days of the mileage.
    """
    a = allocations.where(F.col("is_active")) if active_only else allocations
    first_day, last_day = (mileage.agg(f("mileage_date")).scalar() for f in (F.min, F.max))
    cut = (a.select("van_number", "emp_id", "start_date",
                    F.greatest("start_date", F.when(F.col("start_date").isNotNull(), first_day)).alias("from_day"),
                    F.least("end_date", F.when(F.col("end_date").isNotNull(), last_day)).alias("to_day")))
    days = expand_days(cut, "from_day", "to_day", "a_day")
    # winner order (latest start, then lowest emp_id, NULL emp_id last) as one
    # fixed-width decimal, so the aggregate runs hash-based (a struct order
    # would force a sort-based aggregate over every expanded day)
    start_days = F.datediff(F.col("start_date"), F.lit("1970-01-01").cast("date"))
    if isinstance(a.schema["emp_id"].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        emp_rank = F.when(F.col("emp_id").isNull(), F.lit(0)).otherwise(
            F.lit("20000000000000000000").cast("decimal(38,0)") - F.col("emp_id").cast("decimal(38,0)"))
        order = (start_days.cast("decimal(38,0)") * F.lit("100000000000000000000").cast("decimal(38,0)")
                 + emp_rank).cast("decimal(38,0)")
        pick = F.max_by("emp_id", order)
    else:  # other id types: the same order as a struct (sort-based aggregate)
        pick = F.min_by("emp_id", F.struct(-start_days, F.col("emp_id").isNull(), F.col("emp_id")))
    winner = (days.groupBy(F.col("van_number").alias("a_van"), "a_day")
              .agg(pick.alias("a_emp")))
    j = left_join(mileage, winner, [("van_number", "a_van"), ("mileage_date", "a_day")])
    return j.select(*[F.when(F.col("a_day").isNotNull(), F.col("a_emp")).otherwise(F.col("emp_id"))
                      .cast(mileage.schema["emp_id"].dataType).alias("emp_id")
                      if c == "emp_id" else F.col(c) for c in mileage.columns])

def assign_by_time_range(mileage: DataFrame, allocations: DataFrame, active_only: bool = True, *,
                         at: str = "mileage_ts", start: str = "start_ts", end: str = "end_ts",
                         grain: int = 1) -> DataFrame:
    """P10 at any grain (dates, timestamps, numbers): mileage post-image where
    ``emp_id`` comes from the allocation of the same van whose ``[start, end]``
    holds ``at``, by the rules of ``assign_by_date_range``.

    Nothing is expanded to days or seconds: an allocation is covered by a few
    blocks for each level of its length (``operators.ranges``), and a mileage
    row takes the winner of the last place before it where a van's winner
    changes, so it is moved once.  ``grain``: microseconds of which
    all times are multiples.
    """
    a = allocations.where(F.col("is_active")) if active_only else allocations
    kind = a.schema["emp_id"].dataType
    # Largest first: the start, then having an employee, then the lowest one.
    lowest = -F.col("emp_id").cast("decimal(38,0)") if isinstance(kind, T.NumericType) else _descending(F.col("emp_id"))
    best = F.struct(as_number(F.col(start), a.schema[start].dataType).alias("start"), F.col("emp_id").isNotNull().alias("some"),
                    lowest.alias("lowest"))
    met = with_winner(mileage, a, "van_number", at, start, end, "emp_id", best, grain)
    return met.select(*[F.when(F.col("won").isNotNull(), F.col("won.value")).otherwise(F.col("row.emp_id")).cast(mileage.schema["emp_id"].dataType)
                        .alias("emp_id") if c == "emp_id" else F.col(f"row.`{c}`").alias(c) for c in mileage.columns])


def _descending(text: Column) -> Column:
    """A key whose ascending order is the descending order of the text (bytes
    turned over, and an end that is above every byte)."""
    turned = F.transform(F.filter(F.split(F.hex(text.cast("string")), "(?<=\\G..)"), lambda h: h != ""),
                         lambda h: 255 - F.conv(h, 16, 10).cast("int"))
    return F.concat(turned, F.array(F.lit(256)))
