"""Range joins as equi-joins on dyadic blocks.

Numbers are cut into blocks: at level L a block is ``2 ** (BITS * L)`` numbers
that begin at a multiple of that, so a block of a level is ``2 ** BITS`` blocks
of the level below.  An interval is covered by few disjoint blocks, as in a
segment tree: at most ``2 * (2 ** BITS - 1)`` of each level, that is,
logarithmic in its length and whatever the grain, seconds or microseconds.  A
number lies in one block of each level.  So "start <= x <= end" holds for exactly
one block of the interval, and the join is on (key, level, block): no pair
is formed that the range would reject, and no key holds all of a hot key's
intervals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 2
#: Levels that 64-bit numbers have.
LEVELS = 64 // BITS


def as_number(value: Column, kind, grain: int = 1) -> Column:
    """A date as its day, a timestamp as its microsecond, a number as it is; in
    steps of ``grain``, and an error for a value between two steps."""
    if grain != 1:
        x = as_number(value, kind)
        return F.when(F.pmod(x, F.lit(grain)) != 0, F.raise_error(F.concat(
            F.lit(f"not a multiple of {grain}: "), x.cast("string"))).cast("long")).otherwise(F.call_function("div", x, F.lit(grain).cast("long")))
    if isinstance(kind, T.DateType):
        return F.datediff(value, F.lit("1970-01-01").cast("date")).cast("long")
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), value)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    return value.cast("long")


def _top(first: Column, last: Column) -> Column:
    """The highest level whose blocks are no longer than [first, last]."""
    bits = F.length(F.bin(last - first + 1)) - 1
    return F.call_function("div", bits, F.lit(BITS)).cast("int")


def _of_level(first: Column, last: Column, level: Column) -> Column:
    """array<bigint>: the blocks that a level adds to the cover of [first, last]:
    those inside it that no block of the level above inside it holds."""
    radix = 1 << BITS
    up = lambda x, by: F.call_function("shiftright", x, by)
    a, b = -up(-first, level * BITS), up(last + 1, level * BITS) - 1
    # The first and the last block of the level above that lie inside.
    above_a, above_b = -up(up(-first, level * BITS), F.lit(BITS)), up(up(last + 1, level * BITS), F.lit(BITS)) - 1
    run = lambda x, y: F.when(x <= y, F.sequence(x, y)).otherwise(F.array().cast("array<bigint>"))
    return F.when(above_a > above_b, run(a, b)).otherwise(F.concat(run(a, above_a * radix - 1), run((above_b + 1) * radix, b)))


def cover(first: Column, last: Column) -> Column:
    """array<struct<level, block>>: disjoint blocks that hold the numbers of
    [first, last] and no other; empty if there is none or a bound is NULL.  The
    bounds may span 2 ** 62 numbers at most."""
    first, last = first.cast("long"), last.cast("long")
    blocks = F.flatten(F.transform(F.sequence(F.lit(0), _top(first, last)), lambda level: F.transform(
        _of_level(first, last, level), lambda x: F.struct(level.alias("level"), x.alias("block")))))
    return F.when(first.isNotNull() & last.isNotNull() & (first <= last), blocks).otherwise(
        F.array().cast("array<struct<level:int,block:bigint>>"))


def with_winner(points: DataFrame, intervals: DataFrame, key: str, at: str, start: str, end: str, value: str,
                best: Column, grain: int = 1) -> DataFrame:
    """(``row``, ``won``) for each row of ``points``: the row, and <best, value> of the
    interval of its ``key`` that holds its ``at``, bounds included, and whose ``best``
    (a column over ``intervals``) is largest; NULL if there is none.

    The winner of a key changes only where an interval begins or has ended.  There
    it is looked up by blocks: every block first keeps its best interval, so a place meets at
    most one per level however many overlap; the levels that any block has are few.
    A point takes the winner of the last such place before it, so a point is moved once and
    meets no interval.  For that a key's numbers are cut into stretches, by the
    spread and number of the points; the first number of a stretch is such a place, too.
    ``grain``: what bounds and points are multiples of (1,000,000 for timestamps
    of whole seconds), which spares the levels below it.
    """
    bound = lambda c: as_number(F.col(c), intervals.schema[c].dataType, grain)
    shift = lambda x, by: F.call_function("shiftright", x, by)
    spans = intervals.select(F.col(key).alias("key"), F.col(value).alias("value"), best.alias("best"), bound(start).alias("a"),
                             bound(end).alias("b")).where("key IS NOT NULL AND a <= b")
    # The levels follow from the longest interval, without its blocks.
    highest = spans.agg(F.coalesce(F.max(_top(F.col("a"), F.col("b"))), F.lit(-1))).scalar()
    by_level = spans.select("*", F.explode(F.sequence(F.lit(0), _top(F.col("a"), F.col("b")))).alias("level"))
    held = by_level.select("key", "value", "best", "level", F.explode(_of_level(F.col("a"), F.col("b"), F.col("level"))).alias("block"))
    blocks = held.groupBy("key", "level", "block").agg(F.max(F.struct("best", "value")).alias("won"))

    number = as_number(F.col(at), points.schema[at].dataType, grain)
    numbered = points.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(F.col(key).alias("key"), number.alias("x"))
    # Stretches of 2 ** wide numbers: some 2 ** 4 to 2 ** 11 of a key over the width that evenly
    # spread points of this deviation have, as its average number of points asks for.
    bits = lambda n: F.length(F.bin(n))
    spread = F.least(F.stddev_pop(F.col("x").cast("double")) * F.lit(12 ** .5), F.lit(float(1 << 62))).cast("long")
    wide = F.greatest(bits(spread) - F.greatest(F.lit(4), F.least(F.lit(10), bits(
        F.call_function("div", F.count(F.lit(1)), F.greatest(F.approx_count_distinct("key"), F.lit(1)))) - 8)), F.lit(0))
    wide = numbered.agg(F.coalesce(wide, F.lit(0)).cast("int")).scalar()

    stretch = lambda: shift(F.col("x"), wide)
    firsts = numbered.select("key", stretch().alias("s")).distinct().select("key", F.call_function("shiftleft", F.col("s"), wide).alias("x"))
    places = spans.select("key", F.explode(F.array(F.col("a"), F.col("b") + 1)).alias("x")).unionByName(firsts).distinct()
    probes = places.select("key", "x", F.explode(F.when(highest >= 0, F.sequence(F.lit(0), highest))).alias("level")).withColumn(
        "block", F.expr(f"shiftright(x, level * {BITS})"))
    steps = probes.join(blocks, ["key", "level", "block"], "left").groupBy("key", "x").agg(F.max("won").alias("won"))

    # Rows that nothing can hold are spread, and stand before all places.
    known = F.col(key).isNotNull() & F.col(at).isNotNull()
    hashed = [F.col(f"`{f.name}`") for f in points.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    asked = points.select(F.col(key).alias("key"), F.when(known, number).alias("x"), F.struct(*[F.col(f"`{c}`") for c in points.columns]).alias("row"),
                          F.when(~known, F.pmod(F.xxhash64(*hashed), F.lit(1 << 20))).alias("s"))
    rows = asked.select("key", "x", F.coalesce("s", stretch()).alias("s"), F.lit(True).alias("asks"), "row", F.lit(None).alias("step"))
    known_steps = steps.select("key", "x", stretch().alias("s"), F.lit(False).alias("asks"), F.lit(None).alias("row"), F.struct("won").alias("step"))
    before = Window.partitionBy("key", "s").orderBy("x", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = rows.unionByName(known_steps).withColumn("last", F.last("step", ignorenulls=True).over(before))
    return last.where("asks").select("row", F.when(F.col("x").isNotNull() & F.col("key").isNotNull(), F.col("last.won")).alias("won"))


def winners_in_range(points: DataFrame, intervals: DataFrame, key: str, at: str, start: str, end: str, value: str,
                     best: Column, grain: int = 1) -> DataFrame:
    """(``key``, ``at``, ``value``, ``best``) for each distinct (key, at) of
    ``points`` that an interval of the same key holds: ``with_winner``'s value and best."""
    met = with_winner(points.select(key, at).distinct(), intervals, key, at, start, end, value, best, grain).where("won IS NOT NULL")
    return met.select(F.col(f"row.`{key}`").alias(key), F.col(f"row.`{at}`").alias(at), F.col("won.value").alias(value), F.col("won.best").alias("best"))
