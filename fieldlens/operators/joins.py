"""Join helpers.

Join strategies are left to Catalyst: a side whose size the plan's own
statistics prove small is broadcast, other joins are re-planned by AQE from
measured shuffle sizes, and skewed partitions are split.  A caller that knows a
dimension to be small passes it as ``F.broadcast(dim)``; the hint survives the
projections made here.  Building a DataFrame therefore never runs a job.

``left_join`` is a left outer join in which rows with a NULL join key are spread
over the partitions: they can never match, and a mass of NULL keys (a third of
the rows, say) would otherwise all hash to one reducer.  ``join_in_cells`` is an
inner join for few keys with many rows on both sides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPREADABLE = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType,
               T.TimestampNTZType)


def spare_names(columns, *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores behind it as it takes
    not to be among ``columns`` (compared without case, as Spark does)."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def left_join(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]]) -> DataFrame:
    """``left LEFT JOIN right ON left[l] = right[r] AND ...`` for ``keys`` =
    [(l, r), ...].  One pass over the left side: a further key is 0 on the
    right and for left rows with all keys, and a positive hash of the row for
    the others.  Column names of the two sides must be distinct."""
    if not keys:
        raise ValueError("left_join needs at least one key pair")
    has_keys = reduce(lambda a, b: a & b, [left[lk].isNotNull() for lk, _ in keys])
    spreadable = [F.col(f"`{f.name}`") for f in left.schema if isinstance(f.dataType, _SPREADABLE)]
    place = F.when(has_keys, F.lit(0)).otherwise(1 + F.pmod(F.hash(*spreadable), F.lit(1 << 20)))
    of_left, of_right = spare_names([*left.columns, *right.columns], "place", "zero")
    spread, zero = left.withColumn(of_left, place), right.withColumn(of_right, F.lit(0))
    cond = reduce(lambda a, b: a & b, [spread[lk] == zero[rk] for lk, rk in keys], spread[of_left] == zero[of_right])
    return spread.join(zero, cond, "left").drop(of_left, of_right)


def expand_days(df: DataFrame, start: str, end: str, day_col: str = "day") -> DataFrame:
    """One row per day of ``[start, end]`` (inclusive).  A NULL bound or
    ``start > end`` covers no day, as in ``d >= start AND d <= end``."""
    s, e = F.col(start), F.col(end)
    days = F.when(s.isNotNull() & e.isNotNull() & (s <= e), F.sequence(s, e))
    return df.withColumn(day_col, F.explode(days))


#: Rows of a side that meet in one cell of ``join_in_cells``.
CELL = 4096


def join_in_cells(left: DataFrame, right: DataFrame, keys: list[str], n_left: str, n_right: str, cell: int = CELL,
                  gather: str | None = None) -> DataFrame:
    """``left JOIN right USING (keys)`` for keys with many rows on both sides, whose
    pairs far outnumber the rows.  ``n_left`` and ``n_right`` are columns of both
    sides that tell (or bound from above) how many rows a key has on either.

    The pairs of a key are a rectangle, cut into cells of about ``cell`` rows a side: a
    row lies in one strip of its own side and is repeated for each strip of the other.
    So no task has all pairs of a hot key, and a row is moved once per ``cell``
    partners, not once per partner.  The cells are hashed to
    ``spark.sql.shuffle.partitions`` partitions, which AQE leaves as they are: their
    bytes say little of the pairs they make.

    ``gather``: a column of the right side that comes as an array, NULLs included, of its
    values in the cell, one array for each combination of the other columns.  Pairs can
    then be tested once for all of them and made by ``explode``, which costs less than
    making them by the join.  The merge join takes the left rows one by one; other joins
    might take the arrays so, and would hold all rows of a cell before one is passed on.
    """
    ours, theirs, place = spare_names([*left.columns, *right.columns], "cell_left", "cell_right", "cell_place")
    strips = lambda n: F.greatest(F.ceil(F.col(n) / F.lit(cell)), F.lit(1)).cast("int")

    def in_strips(df, own, n_own):
        spreadable = [F.col(f"`{f.name}`") for f in df.schema if isinstance(f.dataType, _SPREADABLE)]
        return df.withColumn(own, F.pmod(F.xxhash64(*spreadable), strips(n_own)).cast("int"))

    def repeated(df, other, n_other):
        rows = df.withColumn(other, F.explode(F.sequence(F.lit(0), strips(n_other) - 1))).drop(n_left, n_right)
        # Of a key that is a literal on one side, the optimizer makes another shuffle, which AQE would coalesce; not of its hash.
        return rows.withColumn(place, F.xxhash64(*keys, ours, theirs)).repartition(parts, place)

    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    b = in_strips(right, theirs, n_right)
    if gather is not None:
        # collect_list leaves out NULLs, but not structs of one.
        rows = b.groupBy(*[F.col(f"`{c}`") for c in b.columns if c != gather]).agg(F.collect_list(F.struct(F.col(f"`{gather}`").alias("v"))).alias(gather))
        b = rows.withColumn(gather, F.transform(F.col(f"`{gather}`"), lambda x: x["v"]))
    a, b = repeated(in_strips(left, ours, n_left), theirs, n_right), repeated(b, ours, n_left)
    return a.join(b if gather is None else b.hint("merge"), [place, *keys, ours, theirs]).drop(ours, theirs, place)


def join_hot_keys(left: DataFrame, right: DataFrame, keys: list[str], cell: int = CELL, gather: str | None = None) -> DataFrame:
    """``join_in_cells`` of sides whose rows per key are counted first, which drops
    the rows without a partner, too."""
    n_left, n_right = spare_names([*left.columns, *right.columns], "n_left", "n_right")
    count = lambda df, n: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    both = count(left, n_left).join(count(right, n_right), keys)
    return join_in_cells(left.join(both, keys), right.join(both, keys), keys, n_left, n_right, cell, gather)
