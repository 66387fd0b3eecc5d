"""Stored tables: updates rewrite the partitions that change, nothing else, and do so once."""
import os

import pytest
from pyspark.sql import functions as F

from fieldlens.sinks.tables import KeyedTable


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def of_parts(found, parts):
    return {f: t for f, t in found.items() if any(f"part={p}/" in f for p in parts)}


@pytest.fixture
def people(spark, tmp_path):
    rows = [(i, f"k{i % 300}", i % 7, None if i % 11 == 0 else f"n{i}") for i in range(600)] + [(1000, None, 1, "no key")]
    df = spark.createDataFrame(rows, "id long, key string, zone int, name string")
    return KeyedTable(f"{tmp_path}/people", df.schema, ("key",), parts=8).create(df), rows


def content(spark, table):
    return sorted(map(tuple, table.rows(spark).collect()), key=str)


def test_update_rewrites_what_changes_once(spark, people):
    table, rows = people
    assert content(spark, table) == sorted(rows, key=str)
    before = files(table.path)
    changes = spark.createDataFrame([("k5", 9, "new"), ("k5", 9, "new"), ("k6", 1, None), ("k6", 4, None), ("gone", 1, "x"), (None, 5, "y")],
                                    "key string, z int, n string")
    touched = table.update(changes, {"zone": "z", "name": "n"})
    want = [(i, k, *({"k5": (9, "new"), "k6": (4, None)}.get(k, (z, n)))) for i, k, z, n in rows]
    assert content(spark, table) == sorted(want, key=str)
    after = files(table.path)
    assert 1 <= len(touched) <= 2
    rest = [p for p in range(8) if p not in touched]
    assert of_parts(after, rest) == of_parts(before, rest)
    assert not set(of_parts(after, touched)) & set(before)
    # The same update finds nothing that differs.
    assert table.update(changes, {"zone": "z", "name": "n"}) == [] and files(table.path) == after


def test_values_that_are_equal_rewrite_nothing(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 3 if i % 4 else None) for i in range(40)], "key long, zone int")
    table = KeyedTable(f"{tmp_path}/t", df.schema, ("key",), parts=4).create(df)
    before = files(table.path)
    assert table.update(df.select(F.col("key").cast("int"), F.col("zone").cast("string").alias("z")), {"zone": "z"}) == []
    assert files(table.path) == before
    assert len(table.update(spark.createDataFrame([(4, 0), (5, 2)], "key int, z int"), {"zone": "z"})) == 1  # 5 has 2 already
    assert dict(map(tuple, table.rows(spark).collect()))[4] == 0


def test_insert_and_delete(spark, people):
    table, rows = people
    before = files(table.path)
    table.insert(spark.createDataFrame([("zz", 5000), (None, 5001)], "key string, id int"))
    after = files(table.path)
    assert set(before.items()) <= set(after.items())
    more = rows + [(5000, "zz", None, None), (5001, None, None, None)]
    assert content(spark, table) == sorted(more, key=str)
    touched = table.delete(spark.createDataFrame([("zz",), ("k7",), (None,)], "key string"))
    assert content(spark, table) == sorted([r for r in more if r[1] not in ("zz", "k7")], key=str)
    rest = [p for p in range(8) if p not in touched]
    assert of_parts(files(table.path), rest) == of_parts(after, rest)
    # A partition that loses all its rows goes.
    table.delete(table.rows(spark).select("key"))
    assert content(spark, table) == sorted([r for r in more if r[1] is None], key=str)


def test_an_empty_table_and_a_key_that_may_not_be_set(spark, tmp_path):
    schema = "part int, Part_ string, key long"
    df = spark.createDataFrame([], schema)
    table = KeyedTable(f"{tmp_path}/none", df.schema, ("key",), parts=4).create(df)
    assert table.rows(spark).count() == 0 and table.rows(spark).columns == ["part", "Part_", "key"]
    table.insert(spark.createDataFrame([(7, "x", 1)], schema))
    assert [tuple(r) for r in table.rows(spark).collect()] == [(7, "x", 1)]
    assert len(table.update(spark.createDataFrame([(1, 8)], "key int, v int"), {"part": "v"})) == 1
    assert [tuple(r) for r in table.rows(spark).collect()] == [(8, "x", 1)]
    with pytest.raises(ValueError):
        table.update(df, {"key": "part"})
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        table.create(df)


def test_partitions_that_hold_no_changed_key_are_not_read(spark, people):
    table, rows = people
    part = spark.createDataFrame([("k5",)], "key string").select(table.place([F.col("key")])).first()[0]
    for f in files(table.path):
        if f"part={part}/" not in f:
            open(f, "wb").write(b"not parquet")
            os.remove(os.path.join(os.path.dirname(f), "." + os.path.basename(f) + ".crc"))
    assert table.update(spark.createDataFrame([("k5", 99)], "key string, z int"), {"zone": "z"}) == [part]
    assert table.delete(spark.createDataFrame([("k5",)], "key string")) == [part]
