import os
import re

import pytest

from fieldlens.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(text, items, window=10):
    w = WORD.findall(fold(text))
    hit, found = set(), set()
    for i, t in items:
        v = WORD.findall(fold(t))
        n = min(window, len(v))
        for s in range(len(v) - n + 1 if v else 0):
            for d in range(len(w) - n + 1):
                if w[d:d + n] == v[s:s + n]:
                    hit.update(range(d, d + n))
                    found.add(str(i) if i is not None else "")
    return len(w), sorted(hit), sorted(found)


def check(docs, benchmark, items, **more):
    rows = decontam.decontaminate(docs, benchmark, **more).collect()
    for r in rows:
        n, hit, found = brute(r.text, items)
        assert (r.n_words, r.n_hit, r["items"]) == (n, len(hit), found)
        assert r.contaminated == (len(hit) > 0)
        words = [m for m in WORD.finditer(r.text or "")]
        inside = {k for k, m in enumerate(words) if any(s.start <= m.start() and m.end() <= s.end for s in r["spans"])}
        assert inside == set(hit)
    return rows


@pytest.fixture(scope="module")
def items():
    ten = " ".join(f"q{i}" for i in range(14))
    return [(1, ten), (2, "Short Item, here!"), (11, ten.upper()), (3, None), (4, " ... "), (None, "Nullid answer"), (5, "ünï çöde")]


@pytest.mark.parametrize("shard_bytes", [1, 32 << 20])
def test_against_brute_force(spark, items, shard_bytes):
    ten = " ".join(f"Q{i}" for i in range(14))
    texts = ["x " + ten + " y", "x-" + ten.replace(" ", ", ") + ".", ten[3:], "short item here", "shorts item here",
             "a short\nitem\there b", "nullid answer", "ÜNÏ çöde ünï çöde", " ".join(f"q{i}" for i in range(9)), None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = check(docs, spark.createDataFrame(items, ITEMS), items, shard_bytes=shard_bytes)
    assert sum(r.contaminated for r in rows) == 7


def test_edges(spark, edge, empty, items):
    benchmark = spark.createDataFrame([(1, "plain TEXT of a")], ITEMS)
    rows = check(edge.where("doc_id IS NULL OR doc_id <> 5"), benchmark, [(1, "plain TEXT of a")])
    assert sum(r.contaminated for r in rows) == 2
    out = decontam.decontaminate(edge, spark.createDataFrame([], ITEMS))
    assert out.where("contaminated").count() == 0 and out.count() == edge.count()
    assert [c for c in out.columns if c.lower() == "spans"] == ["spans"]
    assert decontam.decontaminate(empty, benchmark).count() == 0


def test_large_benchmark_stays_off_the_driver(spark, items, monkeypatch):
    driver, windows = os.getpid(), decontam.windows

    def refused(*_):
        raise AssertionError("on the driver")

    monkeypatch.setattr(decontam, "windows", lambda *x: windows(*x) if os.getpid() != driver else refused())
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", refused)
    docs = spark.createDataFrame([(1, items[0][1]), (2, "nullid answer, short item here")], "doc_id long, text string")
    out = decontam.decontaminate(docs, spark.createDataFrame(items, ITEMS), shard_bytes=100)
    assert [(r.doc_id, r.n_hit, r["items"]) for r in out.orderBy("doc_id").collect()] == [
        (1, 14, ["1", "11"]), (2, 5, ["", "2"])]


def test_shards_on_a_folder_that_arrow_does_not_read(spark, items, monkeypatch):
    monkeypatch.setattr(decontam, "_arrow_path", lambda path: None)
    test_against_brute_force(spark, items, 1)
