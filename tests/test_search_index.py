"""Trigram search against P6's scan, a regular-expression ILIKE, and the postings it reads."""
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_cells import rows_of_joins

from fieldlens.plans import search, search_index

HIRES = "id long, req_num string, req_status string, hire_status string, zone string, old_emp_id long, manager_id long"
WORDS = ["R-100", "r%x", "a_b", "back\\slash", "Müller", "ÉCOLE", "ab", "a", "", "x y", "Ann", "anna", "100%", "İ", "ΑΣ", "\u0000z", None, "aaa", "line\nend"]
TEXTS = [None, "", "ann", "ANN an", "%", "_", "a_b", "\\_", "\\%", "r\\%x", "x\\", "mül école", "zz", "a  b", " ", "an%a", "l_ne%nd", "%%__", "ab\\c",
         "back\\\\", "aaaa", "aa", "0%", "i", "ας", "z", "n_a l"]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    emps = [(i, rng.choice(WORDS), rng.choice(WORDS)) for i in range(12)]
    hires = [(i, rng.choice(WORDS), rng.choice(["Open", "Hold", None]), rng.choice(["Joined", None]), rng.choice(["Z1", "Z2"]),
              rng.choice([None, *range(15)]), rng.choice([None, *range(14)])) for i in range(60)]
    asked = [(k, t, *(rng.choice([None, v]) if k % 3 == 0 else None for v in ("Open", "Joined", "Z1"))) for k, t in enumerate(TEXTS)]
    return (spark.createDataFrame(hires, HIRES), spark.createDataFrame(emps, "id long, first_name string, last_name string"),
            spark.createDataFrame(asked, "search_id int, search_text string, pos_status string, join_status string, zone string"), asked)


def test_equals_the_scan(spark, tables):
    hires, emps, searches, asked = tables
    got = {}
    for r in search_index.search_many(searches, hires, emps).collect():
        got.setdefault(r["search_id"], []).append(tuple(r)[1:])
    for k, *args in asked:
        want = sorted(map(tuple, search.search_hires(hires, emps, *args).collect()))
        assert sorted(got.get(k, [])) == want, args
    assert sum(map(len, got.values())) > 200


def ilike(text, term):
    """PostgreSQL's pattern '%' || term || '%' as a regular expression."""
    out, pattern, i = "", f"%{term}%".lower(), 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
            c = re.escape(pattern[i])
        else:
            c = {"%": ".*", "_": "."}.get(c, re.escape(c))
        out, i = out + c, i + 1
    return re.fullmatch(out, text.lower(), re.S) is not None


def test_candidates_hold_every_match_and_few_others(spark, tables):
    hires, emps, searches, asked = tables
    index = search_index.build_index(search_index.searchable(hires, emps))
    posted = {(r["id"], r["text"]) for r in index.collect()}
    found = {}
    for r in search_index.candidates(searches, index).collect():
        found.setdefault(r["search_id"], set()).add((r["id"], r["text"]))
    for k, text, *_ in asked:
        if text:
            want = {x for x in posted if x[1] is not None and any(ilike(x[1], t) for t in text.split(" "))}
            assert want <= found.get(k, set()), text
    # "zz" is in no text: nothing is read for it; "ann" is read from one gram's postings.
    assert TEXTS.index("zz") not in found
    assert {t for _, t in found[TEXTS.index("ann")]} <= {"Ann", "anna"}


def test_the_rarest_gram_is_read(spark):
    rows = spark.createDataFrame([(i, "common text " + ("rare" if i == 7 else "more")) for i in range(50)], "id long, text string")
    asked = spark.createDataFrame([(1, "common_text%rare"), (2, "mm"), (3, "%")], "search_id int, search_text string")
    got = search_index.candidates(asked, search_index.build_index(rows)).groupBy("search_id").count().collect()
    assert {r["search_id"]: r["count"] for r in got} == {1: 1, 2: 50, 3: 50}


def test_one_join_without_a_scan_per_search(spark, tables):
    hires, emps, searches, _ = tables
    plan = search_index.search_many(searches, hires, emps)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
    none = search_index.search_many(searches.limit(0), hires, emps)
    assert none.count() == 0


def test_terms_that_a_text_has_to_contain(spark):
    texts = ["ab", "xAB", "a%b", "x%", "x%y", "a_b", "%", "", "a\x00b", "b a"]
    terms = ["ab", "a%", "%AB%", "a%b", "x\\", "\\%", "_", "%%", "a\\_b", "a\x00b", "zz"]
    searches = spark.createDataFrame(list(enumerate(terms)), "search_id int, search_text string")
    needles = {r["term"]: r["needle"] for r in search_index.terms_of(searches).collect()}
    assert needles == {"ab": "ab", "a%": "a", "%AB%": "ab", "a%b": None, "x\\": None, "\\%": "%", "_": None, "%%": "", "a\\_b": "a_b",
                       "a\x00b": None, "zz": "zz"}
    hires = spark.createDataFrame([(k, t, "Open", None, None, None, 1) for k, t in enumerate(texts)], HIRES)
    people = spark.createDataFrame([(1, "#", "#")], "id long, first_name string, last_name string")
    nothing = [F.lit(None).cast("string").alias(c) for c in ("pos_status", "join_status", "zone")]
    got = {(r["search_id"], r["emp_id"]) for r in search_index.search_many(searches.select("*", *nothing), hires, people).collect()}
    assert got == {(i, k) for i, term in enumerate(terms) for k, t in enumerate(texts) if ilike(t, term)}


def test_pairs_are_not_moved(spark):
    """Searches that find all hires by several terms: the rows shuffled are of the tables' size, not of their pairs."""
    hires = spark.range(400).selectExpr("id", "concat('R', id) AS req_num", "'Open' AS req_status", "'Joined' AS hire_status", "concat('Z', id % 2) AS zone",
                                        "id % 5 AS old_emp_id", "id % 5 AS manager_id")
    emps = spark.range(5).selectExpr("id", "'Ann' AS first_name", "concat('L', id) AS last_name")
    searches = spark.range(200).selectExpr("id AS search_id", "CASE id % 3 WHEN 0 THEN 'r ann  l_' WHEN 1 THEN '' ELSE '%' END AS search_text",
                                           "'Open' AS pos_status", "cast(null AS string) AS join_status", "if(id % 2 = 0, 'Z1', null) AS zone")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = search_index.search_many(searches, hires, emps)
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert len(rows) == len(set(rows)) == 100 * 400 + 100 * 200
    assert shuffled(found) < len(rows)


def test_searches_that_ask_the_same_are_tested_at_once(spark):
    """The joins make a row for a hire and what is asked of it, not for each search; a search that comes twice finds twice."""
    hires = spark.range(300).selectExpr("id", "concat('R', id) AS req_num", "'Open' AS req_status", "'Joined' AS hire_status", "'Z' AS zone",
                                        "id % 5 AS old_emp_id", "id % 5 AS manager_id")
    emps = spark.range(5).selectExpr("id", "'Ann' AS first_name", "concat('L', id) AS last_name")
    searches = spark.range(200).selectExpr("id div 2 * 2 AS search_id", "CASE id div 2 % 3 WHEN 0 THEN 'r ann  l_' WHEN 1 THEN '' ELSE 'R1' END AS search_text",
                                           "'Open' AS pos_status", "cast(null AS string) AS join_status", "cast(null AS string) AS zone")
    found = search_index.search_many(searches, hires, emps)
    counts = Counter(tuple(r) for r in found.select("search_id", "emp_id").collect())
    ones = [i for i in range(300) if f"R{i}".startswith("R1")]
    assert counts == {(2 * s, i): 2 for s in range(100) for i in (ones if s % 3 == 2 else range(300))}
    rows = found.groupBy().count()
    assert rows.collect()[0][0] == 2 * (67 * 300 + 33 * len(ones))
    assert rows_of_joins(rows) < 12_000


def shuffled(df) -> int:
    """Rows written by the shuffles of the executed plan."""
    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().get("shuffleRecordsWritten").get().value() if kind == "ShuffleExchangeExec" else 0
        return own + sum(walk(node.children().apply(i)) for i in range(node.children().size()))
    return walk(df._jdf.queryExecution().executedPlan())
