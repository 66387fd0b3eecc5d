"""Where two tables differ, found without shuffling what is equal.

Both tables are dealt into buckets by a hash of the key, and each bucket's rows
are summed up as a checksum that does not depend on their order: their number
and the sum of their hashes, which repeated rows change as well.  Checksums
combine before the shuffle, so a table sends one row per task and bucket.  Only
in buckets that differ the rows are looked at again, in ``buckets`` finer
buckets each, and only rows of finer buckets that differ go on to an exact
comparison.  Equal rows of a differing bucket are the only ones shuffled in vain:
about one in ``buckets ** 2`` for each change.

Equal checksums of different rows are possible in theory: about one in 2 ** 64
buckets that differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import spare_names

BUCKETS = 1024


def _place(keys: list[str], salt: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), *[F.col(k) for k in keys]), F.lit(buckets))


def checksums(df: DataFrame, bucket: Column, columns: list[str]) -> DataFrame:
    """(bucket, n, sum): number and hash sum of each bucket's rows.  The columns'
    types have to be the same in both tables; a NULL is a value of its own."""
    marks = [F.col(c).isNull() for c in columns]  # a NULL adds nothing to a hash
    row = F.xxhash64(*[F.col(c) for c in columns], *marks)
    return (df.select(bucket.alias("bucket"), row.cast("decimal(20,0)").alias("h")).groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("sum")))


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    both = a.select("bucket", F.struct("n", "sum").alias("a")).join(b.select("bucket", F.struct("n", "sum").alias("b")), "bucket", "full")
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select("bucket")


def narrowed(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """Both tables without the rows of buckets that are equal in ``keys`` and
    ``columns`` (names that both have).  No row without an equal one in the other
    table is lost.  The driver sees bucket numbers: at most ``buckets`` first, then
    at most ``buckets`` squared, which are broadcast (8 MB for 1,024)."""
    seen = [*keys, *columns]
    coarse = _place(keys, "coarse", buckets)
    first = [r[0] for r in _differing(*(checksums(df, coarse, seen) for df in (old, new))).collect()]
    if not first:
        return old.limit(0), new.limit(0)
    fine = coarse * buckets + _place(keys, "fine", buckets)
    left = [df.where(coarse.isin(first)) for df in (old, new)]
    second = [(r[0],) for r in _differing(*(checksums(df, fine, seen) for df in left)).collect()]
    spark = old.sparkSession
    out = []
    for df in left:
        name, = spare_names(df.columns, "bucket")
        wanted = F.broadcast(spark.createDataFrame(second, f"{name} long"))
        out.append(df.withColumn(name, fine).join(wanted, name, "left_semi").drop(name))
    return out[0], out[1]


def differences(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``keys``, ``columns`` and ``old_n``, ``new_n``: the rows that stand in one
    table more often than in the other, and how often in each."""
    seen = [*keys, *columns]
    a, b = narrowed(old, new, keys, columns, buckets)
    sides = [df.select(*seen, F.lit(i).alias("old_n"), F.lit(1 - i).alias("new_n")) for df, i in ((a, 1), (b, 0))]
    counts = sides[0].unionByName(sides[1]).groupBy(*seen).agg(*[F.sum(c).cast("long").alias(c) for c in ("old_n", "new_n")])
    return counts.where("old_n <> new_n")
