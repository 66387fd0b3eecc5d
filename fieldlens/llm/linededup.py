"""Line deduplication over windows of consecutive lines, in DataFrame terms.

A document's lines are what stands between line feeds.  A line counts if it
has other than ASCII white space; lines are compared without it at their ends.
Each ``window`` consecutive counting lines make a window, windows overlap.  A
window that occurs several times in the corpus keeps its first occurrence, by
document id and position; each later occurrence covers its lines and the blank
ones between them, covered positions merge, and covered lines are removed.

Windows are keyed by 96 bits of hash.  They are counted with a grouped
minimum, which combines before the shuffle, and joined back to the few that
repeat, where a frequent window's rows can be split over tasks; nothing is
gathered but the positions of one document.  Texts are shuffled once, by
document.

Defined cases: null texts stay null and texts of fewer counting lines than
the window stay as they are; rows that agree in id and text are one document
and get the same result; documents that share an id are told apart and
ordered by a hash of their text; null ids come first; a text that loses all
lines becomes empty and its row stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import spare_names
from .common import with_columns

WINDOW = 3
_WHITE = " \t\r\x0b\x0c"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, not at each use in it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _windows(text: Column, window: int) -> Column:
    """array<struct<pos, start, end, k1, k2>>: the number of counting lines
    before the window, its first and last line, and its key."""

    def hashed(line, i):
        bare = F.trim(line, F.lit(_WHITE))
        return F.struct(i.alias("i"), (bare == "").alias("blank"), F.xxhash64(bare).alias("a"), F.hash(bare).alias("b"))

    counting = F.filter(F.transform(F.split(text, "\n", -1), hashed), lambda x: ~x["blank"])

    def keys(lines):
        def key(pos):
            parts = [F.get(lines, pos + k) for k in range(window)]
            return F.struct(pos.alias("pos"), parts[0]["i"].alias("start"), parts[-1]["i"].alias("end"),
                            F.xxhash64(*[p["a"] for p in parts]).alias("k1"),
                            F.hash(*[p["b"] for p in parts]).alias("k2"))

        last = F.size(lines) - window
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), key))

    return _let(counting, keys)


def _cut(text: Column, ranges: Column) -> Column:
    """The text without the lines of the ranges, sorted structs (pos, start, end)."""

    def pieces(x):
        lines, cuts = x["lines"], x["cuts"]

        def after(cut, i):
            until = F.coalesce(F.get(cuts, i + 1)["start"], F.size(lines))
            return F.slice(lines, cut["end"] + 2, F.greatest(until - cut["end"] - 1, F.lit(0)))

        head = F.slice(lines, F.lit(1), F.get(cuts, F.lit(0))["start"])
        return F.array_join(F.flatten(F.concat(F.array(head), F.transform(cuts, after))), "\n")

    return _let(F.struct(F.split(text, "\n", -1).alias("lines"), ranges.alias("cuts")), pieces)


def _removed(ranges: Column, window: int) -> Column:
    """How many counting lines the sorted ranges cover together."""

    def own(cuts):
        return F.transform(cuts, lambda c, i: F.least(F.lit(window), F.get(cuts, i + 1)["pos"] - c["pos"]))

    return F.aggregate(_let(ranges, own), F.lit(0).cast("long"), lambda n, x: n + x)


def later_windows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW) -> DataFrame:
    """(id, hash, pos, start, end) of the windows that occurred before."""
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"),
                        F.explode(_windows(F.col(text_col), window)).alias("w"))
    placed = keyed.select("w.k1", "w.k2", F.struct("id", "hash", "w.pos", "w.start", "w.end").alias("at"))
    repeated = (placed.groupBy("k1", "k2").agg(F.min("at").alias("first"), F.max("at").alias("last"))
                .where("first <> last").drop("last"))
    return placed.join(repeated, ["k1", "k2"]).where("at <> first").select("at.*")


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                window: int = WINDOW) -> DataFrame:
    """``docs`` with the text less its repeated windows, and ``lines_removed``
    long: how many counting lines went."""
    later = later_windows(docs, id_col=id_col, text_col=text_col, window=window)
    of, its_id, its_hash, cuts = spare_names(docs.columns, "of", "its_id", "its_hash", "cuts")
    covered = (later.groupBy(F.col("id").alias(its_id), F.col("hash").alias(its_hash))
               .agg(F.array_sort(F.collect_set(F.struct("pos", "start", "end"))).alias(cuts)))  # of one document
    joined = (docs.withColumn(of, F.xxhash64(text_col))
              .join(covered, F.col(id_col).eqNullSafe(F.col(its_id)) & (F.col(of) == F.col(its_hash)), "left"))
    cut = F.col(cuts).isNotNull()
    new = {text_col: F.when(cut, _cut(F.col(text_col), F.col(cuts))).otherwise(F.col(text_col)),
           "lines_removed": F.when(cut, _removed(F.col(cuts), window)).otherwise(F.lit(0).cast("long"))}
    out = with_columns(joined, new)
    order = [c for c in docs.columns if c.lower() != "lines_removed"] + ["lines_removed"]
    return out.select(*[F.col(f"`{c}`") for c in order])


def oracle(window: int = WINDOW) -> str:
    """DuckDB SQL for the query's rows: doc_id, text, lines_removed."""
    if window != 3:
        raise ValueError("the SQL states windows of three lines")
    return r"""
WITH line AS (
  SELECT d.doc_id, d.text, u.i, u.line, trim(u.line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS bare
  FROM (SELECT DISTINCT doc_id, text FROM documents) d,
       LATERAL (SELECT unnest(string_split(d.text, chr(10))) AS line,
                       generate_subscripts(string_split(d.text, chr(10)), 1) AS i) u),
win AS (
  SELECT doc_id, text, i AS first_line, lead(i, 2) OVER w AS last_line,
         bare AS l1, lead(bare, 1) OVER w AS l2, lead(bare, 2) OVER w AS l3
  FROM line WHERE bare <> '' WINDOW w AS (PARTITION BY doc_id, text ORDER BY i)),
later AS (
  SELECT doc_id, text, first_line, last_line FROM (
    SELECT *, row_number() OVER (PARTITION BY l1, l2, l3 ORDER BY doc_id NULLS FIRST, text, first_line) AS n
    FROM win WHERE l3 IS NOT NULL) WHERE n > 1),
gone AS (
  SELECT DISTINCT doc_id, text, unnest(range(first_line, last_line + 1)) AS i FROM later),
cleaned AS (
  SELECT p.doc_id, p.text,
         coalesce(string_agg(p.line, chr(10) ORDER BY p.i) FILTER (WHERE g.i IS NULL), '') AS new_text,
         count(*) FILTER (WHERE g.i IS NOT NULL AND p.bare <> '') AS lines_removed
  FROM line p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.text = g.text AND p.i = g.i
  GROUP BY p.doc_id, p.text)
SELECT d.doc_id, CASE WHEN c.lines_removed > 0 THEN c.new_text ELSE d.text END AS text,
       coalesce(c.lines_removed, 0)::BIGINT AS lines_removed
FROM documents d LEFT JOIN cleaned c ON d.doc_id = c.doc_id AND d.text = c.text"""
