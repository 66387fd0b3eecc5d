"""P6 for many searches at once: an inverted index of trigrams.

``search_hires`` scans every hire for each search.  Here the texts that a search
looks at are posted once under each of their grams (all runs of three, two and
one characters of the lower-case text, and the empty gram for every text), and a
table of searches is answered by one equi-join: each term's pattern is cut at
its wildcards, the grams of its literal pieces are looked up by how often they
are posted, and only the postings of the term's rarest gram are read and tested
with the whole pattern.  A term whose rarest gram is not posted finds nothing.

Rules for terms without three literal characters in a row: pieces of one or two
characters are grams themselves; a term that is empty or all wildcards has the
empty gram, which every text has; a search without a text (NULL or '') finds
every hire through a posting of its own, so no search is joined to all hires but
those that ask for all of them.  Terms are split, escaped and matched as in P6.

What is tested and returned is posted with the gram, so a pair of a search and a
hire needs no further join.  Postings of a frequent gram meet its searches in cells
(``operators.joins.join_in_cells``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import let, pg_concat, pg_split
from ..operators.joins import join_in_cells, left_join

#: Grams are of three characters, as in the usual trigram index.
GRAM = 3
_CUT = "\x00"  # stands for a wildcard between literal pieces


def grams_of(text: Column) -> Column:
    """array<string>: the distinct runs of 1 to ``GRAM`` characters of the
    lower-case text, and the empty one."""
    low = F.lower(text)

    def runs(n: int) -> Column:
        last = F.length(low) - (n - 1)
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: low.substr(i, F.lit(n)))).otherwise(
            F.array().cast("array<string>"))

    return F.array_distinct(F.concat(F.array(F.lit("")), *[runs(n) for n in range(1, GRAM + 1)]))


def searchable(hires: DataFrame, employees: DataFrame) -> DataFrame:
    """(id, text): what P6 looks at of each hire, and a NULL text for the hire itself."""
    people = employees.select(F.col("id").alias("e_id"), "first_name", "last_name")
    both = left_join(hires.select("id", "req_num", "old_emp_id"), people, [("old_emp_id", "e_id")])
    texts = F.array("req_num", "first_name", "last_name")
    return both.select("id", F.explode(F.concat(F.array(F.lit(None).cast("string")), F.filter(texts, lambda t: t.isNotNull()))).alias("text"))


def build_index(rows: DataFrame) -> DataFrame:
    """(gram, id, text) postings of (id, text) rows; rows with a NULL text are
    posted under a NULL text in the gram of the searches for everything."""
    gram = F.when(F.col("text").isNull(), F.array(F.lit(_CUT))).otherwise(grams_of(F.col("text")))
    return rows.distinct().select(F.explode(gram).alias("gram"), "id", "text")


def terms_of(searches: DataFrame) -> DataFrame:
    """(search_id, term, pattern, needle, piece, grams) of the searches' distinct terms:
    ``pattern`` for Spark's LIKE, ``needle`` what a lower-case text has to contain
    if that is all that the term asks for (NULL otherwise), ``piece`` the longest of what
    it has to contain in any case, ``grams`` of which any can be looked up."""
    split = F.when(F.coalesce(F.col("search_text"), F.lit("")) == "", F.array(F.lit(None).cast("string"))).otherwise(
        pg_split(F.col("search_text"), " "))
    terms = searches.select("search_id", F.explode(F.array_distinct(split)).alias("term"))
    # The pattern's characters: an escaped one with its backslash, or one alone.
    tokens = F.regexp_extract_all(F.concat(F.lit("%"), F.lower("term"), F.lit("%")), F.lit(r"(?s)\\.|."), F.lit(0))
    wild = lambda t: t.isin("%", "_")
    escaped = lambda t: (F.length(t) == 2) & t.startswith("\\")
    literal = lambda t: F.when(wild(t), _CUT).when(escaped(t), F.substring(t, 2, 1)).otherwise(t)
    for_like = lambda t: F.when(escaped(t) & ~F.substring(t, 2, 1).isin("%", "_", "\\"), F.substring(t, 2, 1)).otherwise(t)

    def cut(found: Column) -> Column:
        pieces = F.filter(F.split(F.array_join(F.transform(found, literal), ""), _CUT), lambda p: p != "")
        runs = lambda p: F.when(F.length(p) < GRAM, F.array(p)).otherwise(
            F.transform(F.sequence(F.lit(1), F.length(p) - (GRAM - 1)), lambda i: p.substr(i, F.lit(GRAM))))
        grams = F.flatten(F.transform(pieces, runs))
        # Without "_" and with at most one piece, the wildcards are all at the ends;
        # a backslash at the term's end takes the last one away.
        plain = ~F.exists(found, lambda t: (t == "_") | t.contains(_CUT)) & (F.size(pieces) <= 1) & (F.element_at(found, -1) == "%")
        return F.struct(F.array_join(F.transform(found, for_like), "").alias("pattern"),
                        F.when(plain, F.array_join(pieces, "")).alias("needle"),
                        F.coalesce(F.array_max(F.transform(pieces, lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))["p"], F.lit("")).alias("piece"),
                        F.when(F.size(grams) > 0, F.array_distinct(grams)).otherwise(F.array(F.lit(""))).alias("grams"))

    every = F.struct(F.lit(None).cast("string").alias("pattern"), F.lit(None).cast("string").alias("needle"),
                     F.lit(None).cast("string").alias("piece"), F.array(F.lit(_CUT)).alias("grams"))
    return terms.select("search_id", "term", F.when(F.col("term").isNull(), every).otherwise(let(tokens, cut)).alias("t")).select(
        "search_id", "term", "t.pattern", "t.needle", "t.piece", "t.grams")


def rarest_grams(searches: DataFrame, index: DataFrame) -> DataFrame:
    """``terms_of`` the searches with the gram of each that is posted least, ``gram``,
    and its number of postings, ``n``; terms with a gram that is not posted find
    nothing and are left out."""
    looked = terms_of(searches).withColumn("gram", F.explode("grams")).drop("grams")
    often = index.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    sized = looked.join(often, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = sized.groupBy("search_id", "term", "pattern", "needle", "piece").agg(F.min(F.struct("n", "gram")).alias("least"))
    return rarest.select("search_id", "term", "pattern", "needle", "piece", "least.gram", "least.n").where("n > 0")


def candidates(searches: DataFrame, index: DataFrame) -> DataFrame:
    """(search_id, pattern, needle, id, text): postings of each term's rarest gram."""
    rarest = rarest_grams(searches, index)
    grams = rarest.groupBy("gram").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("t"))
    met = join_in_cells(rarest.drop("n").join(grams, "gram"), index.join(grams, "gram"), ["gram"], "t", "n")
    return met.select("search_id", "pattern", "needle", "id", "text")


def _asked(searches: DataFrame, index: DataFrame) -> DataFrame:
    """One row for each search and each of its terms: search_id, pattern, needle, piece,
    the ``earlier`` terms of the search, and the ``key`` under which hires are looked up,
    the rarest gram with the filters; ``n`` and ``t`` bound the hires and count the terms
    of the key."""
    before = Window.partitionBy("search_id").orderBy(F.desc("n"), "term").rowsBetween(Window.unboundedPreceding, -1)
    terms = rarest_grams(searches.where("search_id IS NOT NULL"), index).withColumn(
        "earlier", F.collect_list(F.struct("pattern", "needle", "piece")).over(before))
    filters = searches.select("search_id", F.struct(F.col("pos_status").alias("pos"), F.col("join_status").alias("join"), "zone").alias("want"))
    asked = filters.join(terms, "search_id").withColumn("key", F.struct("gram", "want"))
    sizes = asked.groupBy("key").agg(F.count(F.lit(1)).alias("t"))
    return asked.join(sizes, "key").select("key", "search_id", "pattern", "needle", "piece", "earlier", "n", "t")


def _found_rows(hires: DataFrame, employees: DataFrame) -> DataFrame:
    """What is returned of each hire with a manager, its filtered columns, ``lows``, the
    distinct lower-case texts of its id, and ``low``, those in one text."""
    names = lambda p: employees.select(F.col("id").alias(f"{p}_id"), pg_concat(
        F.col("first_name"), " ", F.col("last_name")).alias(f"{p}_name"))
    named = left_join(hires.select("id", "req_status", "hire_status", "zone", "old_emp_id", "manager_id"), names("e"), [("old_emp_id", "e_id")])
    managers = names("m")
    rows = named.join(managers, named["manager_id"] == managers["m_id"]).select(
        "id", "req_status", "hire_status", "zone", F.coalesce("e_name", F.lit(" ")).alias("emp_full_name"),
        F.col("manager_id").alias("emp_manager_id"), F.col("m_name").alias("manager_name"))
    lows = searchable(hires, employees).groupBy("id").agg(F.collect_set(F.lower("text")).alias("lows"))
    # No needle has a _CUT, so none is found across two texts.
    return rows.join(lows.withColumn("low", F.when(F.size("lows") > 0, F.array_join("lows", _CUT))), "id")


def search_many(searches: DataFrame, hires: DataFrame, employees: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """P6's rows for each of ``searches`` (search_id, search_text, pos_status,
    join_status, zone; NULL: not asked for), with its ``search_id``.  ``index``:
    ``build_index(searchable(hires, employees))``, stored or made here.

    The index tells which hires have a looked-up gram.  Such a hire is posted with
    all that is tested and returned, once under each gram and set of filters asked
    with it that it meets.  A search finds a hire by the first of its terms that the
    hire holds, which the pair itself tells; so pairs of searches and hires, many times
    the tables, are neither moved nor made distinct.  Searches that ask the same of a
    hire meet it as one array of their ids (``gather``): it is tested once for them."""
    index = build_index(searchable(hires, employees)) if index is None else index
    asked = _asked(searches, index)
    keys = asked.groupBy("key").agg(F.max("n").alias("n"), F.max("t").alias("t")).withColumn("gram", F.col("key.gram"))
    looked = index.select("gram", "id").join(keys.select("gram").distinct(), "gram", "left_semi")
    posted = looked.repartition("id").dropDuplicates(["id", "gram"]).join(_found_rows(hires, employees), "id")
    same = lambda want, has: F.col(f"key.want.{want}").isNull() | (F.col(f"key.want.{want}") == F.col(has))
    kept = posted.join(keys, "gram").where(same("pos", "req_status") & same("join", "hire_status") & same("zone", "zone")).select(
        "key", "id", "emp_full_name", "emp_manager_id", "manager_name", "lows", "low", "n", "t")
    # LIKE makes a regular expression of each row's pattern; most pairs need none, and no loop over the texts.
    holds = lambda p: (f"CASE WHEN {p}pattern IS NULL THEN true WHEN NOT coalesce(contains(low, {p}piece), false) THEN false "  # noqa: E731
                       f"WHEN {p}needle IS NOT NULL THEN true ELSE exists(lows, x -> x LIKE {p}pattern) END")
    first = f"size(earlier) = 0 OR NOT exists(earlier, e -> {holds('e.')})"
    met = join_in_cells(kept, asked, ["key"], "n", "t", gather="search_id").where(f"({holds('')}) AND ({first})")
    return met.select(F.explode("search_id").alias("search_id"), F.col("id").alias("emp_id"), "emp_full_name", "emp_manager_id", "manager_name")
