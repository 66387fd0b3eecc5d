"""How filters interact in every order: Lehmer-rank difference arrays.

Each document has a mask of the filters that it fails.  In an order of the
filters it goes at the first one in its mask.  Orders are numbered by their
lexicographic (Lehmer) rank, so all orders that begin with the same letters are
an interval of ranks; a mask is removed at a step in the orders that begin with
letters outside the mask and have one of its letters there, a few intervals
for each mask and step.  The documents of a mask are added at the start of each
interval and taken away behind its end; running sums over the ranks then give
what every order removes at every step.  So documents are only counted by mask;
the work after that depends on the number of parts, not of documents.

Filters, over whole texts (null: empty; words are split at ASCII white space):
A under 100 words; B fewer than 80 distinct words in a hundred; C over 10
capitals A-Z in a hundred code points; D holds one of ``#$%&*|``; E is
identical to the text of a smaller id anywhere in the table.  Texts are compared by
SHA-256 and length; they are not shuffled.

Defined cases: a part is a value of the part column, null and empty text are
the empty part; rows with a null id are neither copies nor originals (E
passes) and have no labels; repeated rows of one id are copies of a smaller id
only, not of each other, and count one by one; of several labels of an id, any
1 counts; an empty table has no parts and no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window, functions as F

FILTERS = "ABCDE"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, not at each use in it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def own_mask(text: Column) -> Column:
    """int: the bits of A to D, which depend on the text alone."""
    text = F.coalesce(text, F.lit(""))

    def bits(words):
        n, distinct = F.size(words), F.size(F.array_distinct(words))
        capitals = (F.length(text) - F.length(F.translate(text, _CAPITALS, ""))).cast("long")
        fails = [n < 100, distinct.cast("long") * 100 < n.cast("long") * 80,
                 capitals * 100 > F.length(text).cast("long") * 10, text.rlike("[#$%&*|]")]
        return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))

    return _let(F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != ""), bits)


def rank(prefix: str) -> int:
    """Lexicographic rank of the first order that begins with ``prefix``."""
    left, r = list(FILTERS), 0
    for letter in prefix:
        k = left.index(letter)
        r += k * factorial(len(left) - 1)
        left.pop(k)
    return r


def removal_intervals() -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank behind the last) of all orders that remove
    the mask at the step: those that begin with step - 1 letters outside the
    mask and one in it."""
    found = []
    for mask in range(1, 1 << len(FILTERS)):
        inside = [f for k, f in enumerate(FILTERS) if mask >> k & 1]
        outside = [f for f in FILTERS if f not in inside]
        for step in range(1, len(outside) + 2):
            for before in permutations(outside, step - 1):
                for last in inside:
                    lo = rank("".join(before) + last)
                    found.append((mask, step, lo, lo + factorial(len(FILTERS) - step)))
    return found


def mask_counts(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part and mask, and those
    of them labelled good or toxic."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       own_mask(F.col(text_col)).alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest"),
                       F.octet_length(text).alias("size"))
    each = rows.groupBy("digest", "size", "id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    marks = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg(F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
                  F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic")))
    marked = (each.where("id IS NOT NULL").join(marks, "id", "left").na.fill(0, ["good", "toxic"])
              .unionByName(each.where("id IS NULL").withColumns({"good": F.lit(0), "toxic": F.lit(0)})))
    # A text's rows shrink to one for each part and label before they meet: a text
    # that fills a third of the table is few rows here.
    alike = marked.groupBy("digest", "size", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("id").alias("least"), F.min_by("n", "id").alias("n_least"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("n_null"))
    of_text = Window.partitionBy("digest", "size")
    originals = F.when(F.col("least") == F.min("least").over(of_text), F.col("n_least")).otherwise(0)
    split = alike.select("part", "mask", "good", "toxic", (F.col("n_null") + originals).alias("first"), "n")
    both = split.select("part", "good", "toxic", F.explode(F.array(
        F.struct("mask", F.col("first").alias("n")),
        F.struct(F.col("mask").bitwiseOR(16).alias("mask"), (F.col("n") - F.col("first")).alias("n")))).alias("x"))
    n = F.col("x.n")
    return both.where("x.n > 0").groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic"))


def audit_orders(counts: DataFrame) -> DataFrame:
    """One row per part, order and step: part, filter_order, step, filter,
    kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    spark = counts.sparkSession
    sums = ["n", "good", "toxic"]
    intervals = spark.createDataFrame(removal_intervals(), "mask int, step int, lo int, hi int")
    ends = counts.join(F.broadcast(intervals), "mask").select("part", "step", F.explode(F.array(
        F.struct(F.col("lo").alias("rank"), *sums),
        F.struct(F.col("hi").alias("rank"), *[(-F.col(c)).alias(c) for c in sums]))).alias("x")).select("part", "step", "x.*")
    orders = spark.createDataFrame([(r, "".join(p)) for r, p in enumerate(permutations(FILTERS))],
                                   "rank int, filter_order string")
    # Every rank of every step of a part stands there, with nothing added if no interval ends there.
    steps = counts.select("part").distinct().select("part", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    grid = steps.select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(factorial(len(FILTERS)) - 1))).alias("rank"),
                        *[F.lit(0).cast("long").alias(c) for c in sums])
    array = ends.unionByName(grid).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in sums])
    so_far = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    removed = array.select("part", "step", "rank", *[F.sum(c).over(so_far).alias(c) for c in sums])
    named = removed.join(F.broadcast(orders), "rank").withColumn("filter", F.expr("substring(filter_order, step, 1)"))
    fails = counts.select("part", "mask", "n", F.explode(F.array(*[
        F.struct(F.lit(f).alias("filter"), F.lit(1 << k).alias("bit")) for k, f in enumerate(FILTERS)])).alias("f"))
    has = F.col("mask").bitwiseAND(F.col("f.bit")) > 0
    of_filter = fails.groupBy("part", F.col("f.filter").alias("filter")).agg(
        F.sum(F.when(has, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("mask") == F.col("f.bit"), F.col("n")).otherwise(0)).alias("unique_fails"),
        F.sum("n").alias("total"))
    before = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    joined = named.join(of_filter, ["part", "filter"])
    out = joined.select("part", "filter_order", "step", "filter", (F.col("total") - F.sum("n").over(before)).alias("kept"),
                        F.col("n").alias("removed"), (F.col("fails") - F.col("n")).alias("redundant"), "unique_fails",
                        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
                        F.sum("n").over(Window.partitionBy("part", "filter")).alias("shapley"))
    return out


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """``audit_orders`` over the documents' ``mask_counts``."""
    return audit_orders(mask_counts(docs, labels, **columns))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS mask
  FROM d LEFT JOIN l USING (doc_id)),
perm AS (
  SELECT '' AS o UNION ALL
  SELECT o || f FROM perm, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f) WHERE length(o) < 5 AND NOT contains(o, f)),
place AS (SELECT o AS filter_order, s AS step, o[s] AS f, o[1:s] AS upto, o[1:s - 1] AS earlier
       FROM perm, (SELECT unnest(range(1, 6)) AS s) WHERE length(o) = 5),
c AS (SELECT part, mask, good, toxic, count(*) AS n FROM m GROUP BY ALL),
x AS (
  SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (translate(mask, upto, '') = mask), 0) AS kept,
         coalesce(sum(n) FILTER (contains(mask, f) AND translate(mask, earlier, '') = mask), 0) AS removed,
         coalesce(sum(n) FILTER (contains(mask, f) AND translate(mask, earlier, '') <> mask), 0) AS redundant,
         coalesce(sum(n) FILTER (mask = f), 0) AS unique_fails,
         coalesce(sum(n) FILTER (good AND contains(mask, f) AND translate(mask, earlier, '') = mask), 0) AS good_lost,
         coalesce(sum(n) FILTER (toxic AND contains(mask, f) AND translate(mask, earlier, '') = mask), 0) AS toxic_lost
  FROM c, place GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, f AS "filter", kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM x"""
