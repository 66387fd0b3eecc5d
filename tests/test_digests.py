"""Differences by checksums: against bags of rows, and how many rows are left to compare."""
import random
from collections import Counter

import pytest

from fieldlens.operators import digests

SCHEMA = "k string, a int, b string, bucket int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("buckets", [2, 16, 1024])
def test_differences_equal_bags_of_rows(spark, buckets):
    rng = random.Random(buckets)
    pick = lambda: (rng.choice([None, *map(str, range(30))]), rng.choice([None, 0, 1]), rng.choice([None, "", "x"]), 7)
    old = [pick() for _ in range(200)]
    new = [r for r in old if rng.random() < .9] + [pick() for _ in range(20)]
    got = {tuple(r)[:3]: tuple(r)[3:] for r in digests.differences(frame(spark, old), frame(spark, new), ["k"], ["a", "b"], buckets).collect()}
    a, b = Counter(r[:3] for r in old), Counter(r[:3] for r in new)
    assert got == {k: (a[k], b[k]) for k in a | b if a[k] != b[k]} != {}


def test_equal_rows_are_left_out(spark):
    rows = [(str(i), i % 5, "x", 1) for i in range(20_000)]
    old, new = frame(spark, rows), frame(spark, rows[::-1])
    a, b = digests.narrowed(old, new, ["k"], ["a", "b"])
    assert a.count() == b.count() == 0 and a.columns == old.columns
    changed = [(k, 9 if k in ("7", "19999") else n, x, y) for k, n, x, y in rows if k != "500"] + [("501", 1, "x", 1)]
    a, b = digests.narrowed(old, frame(spark, changed), ["k"], ["a", "b"], 256)
    assert {"7", "500", "501", "19999"} <= {r["k"] for r in a.collect()} and a.count() < 20 and b.count() < 20


def test_nulls_and_empty_tables(spark):
    one, other = frame(spark, [("k", None, "x", 1)]), frame(spark, [("k", 1, None, 1)])
    assert digests.differences(one, other, ["k"], ["a", "b"]).count() == 2
    assert digests.differences(one, one, ["k"], ["a", "b"]).count() == 0
    none = frame(spark, [])
    assert [tuple(r) for r in digests.differences(none, one, ["k"], ["a", "b"]).collect()] == [("k", None, "x", 0, 1)]
    assert digests.differences(none, none, ["k"], ["a", "b"]).count() == 0
