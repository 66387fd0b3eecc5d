"""Filter interaction audit: against a replay of every order, and SQL."""
from collections import Counter
from itertools import permutations
import re

import pytest
from pyspark.sql import functions as F

from fieldlens.llm import filteraudit


def replay(docs, labels):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
    masks = []
    for i, text, part in docs:
        t = text or ""
        w = words(t)
        m = "A" * (len(w) < 100) + "B" * (100 * len(set(w)) < 80 * len(w))
        m += "C" * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t)) + "D" * bool(re.search("[#$%&*|]", t))
        m += "E" * (i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs))
        lab = [x for x in labels if x[0] == i and i is not None]
        masks.append((part or "", m, any(q == 1 for _, q, _ in lab), any(x == 1 for _, _, x in lab)))
    out, shap = {}, Counter()
    for part in {x[0] for x in masks}:
        rows = [x for x in masks if x[0] == part]
        for o in map("".join, permutations("ABCDE")):
            left = rows
            for s, f in enumerate(o, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                fails = sum(f in x[1] for x in rows)
                out[part, o, s] = [len(left), len(gone), fails - len(gone), sum(x[1] == f for x in rows),
                                   sum(x[2] for x in gone), sum(x[3] for x in gone)]
                shap[part, f] += len(gone)
    return {k: (*v, shap[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def result(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in df.collect()}


LONG = " ".join(f"w{i}" for i in range(120))
DOCS = [(1, LONG, "en"), (2, LONG, "en"), (2, LONG, "de"), (None, LONG, "en"), (3, "ABC DEF", "en"), (4, None, None),
        (5, "", ""), (6, "a a a $", "de"), (7, "a a a $", "en"), (8, LONG + " #", "en"), (9, "X " * 150, "en"),
        (1, LONG, "en"), (10, "\x1c one\x0btwo", "en"), (11, "É" * 10 + "AB", "de"), (12, "  b", "de")]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, 0, 1), (7, None, 1), (None, 1, 1), (8, 1, None), (99, 1, 1)]


def frames(spark):
    return (spark.createDataFrame(DOCS, "doc_id long, text string, lang string"),
            spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int"))


def test_equals_a_replay_of_all_orders(spark):
    assert result(filteraudit.audit(*frames(spark))) == replay(DOCS, LABELS)


def test_every_order_removes_a_mask_once():
    seen = Counter()
    for mask, step, lo, hi in filteraudit.removal_intervals():
        for r in range(lo, hi):
            seen[mask, r] += 1
            order = list(permutations("ABCDE"))[r]
            assert next(s for s, f in enumerate(order, 1) if mask >> "ABCDE".index(f) & 1) == step
    assert set(seen.values()) == {1} and len(seen) == 31 * 120


def test_edge_cases(spark, edge, empty):
    labels = frames(spark)[1]
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in edge.collect()]
    assert result(filteraudit.audit(edge, labels)) == replay(rows, LABELS)
    assert filteraudit.audit(empty, labels).count() == 0
    assert result(filteraudit.audit(edge, labels.limit(0))) == replay(rows, [])


def test_equals_sql():
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", DOCS)
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", LABELS)
    cols = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    want = {r[:3]: r[3:] for r in con.sql(f"SELECT {', '.join(cols)} FROM ({filteraudit.ORACLE})").fetchall()}
    assert want == replay(DOCS, LABELS)


def test_stays_native(spark):
    plan = filteraudit.audit(*frames(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
