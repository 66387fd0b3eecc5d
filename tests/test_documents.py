"""One JSON document from many parts."""
import glob
import json
import random

import pytest

from fieldlens.sinks import documents


def whole(path):
    return "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{path}/part-*")))


@pytest.mark.parametrize("n,parts", [(0, 5), (1, 5), (2, 7), (300, 1), (300, 6), (5, 40)])
def test_parts_are_one_array_in_order(spark, tmp_path, n, parts):
    rng = random.Random(n + parts)
    rows = [(rng.choice([None, *range(9)]), rng.choice(["a", "]", "[", ",", None, "line\nend", "é \"q\" \\"]), i % 7) for i in range(n)]
    df = spark.createDataFrame(rows, "last int, json string, x int").repartition(4)
    documents.write_json_array(df, f"{tmp_path}/d", ["last", "json"], parts)
    found = json.loads(whole(f"{tmp_path}/d"))
    key = lambda r: (r["last"] is not None, r["last"] or 0, r["json"] is not None, r["json"] or "", json.dumps(r))
    assert sorted((tuple(r.values()) for r in found), key=str) == sorted(rows, key=str)
    assert [key(r)[:4] for r in found] == sorted(key(r)[:4] for r in found)
    back = [json.loads(r["json"]) for r in documents.read_json_array(spark, f"{tmp_path}/d").collect()]
    assert sorted(back, key=str) == sorted(found, key=str)
    if n == 300 and parts == 6:
        assert sum(bool(open(f).read()) for f in glob.glob(f"{tmp_path}/d/part-*")) > 3


def test_repeated_rows_and_one_key(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")] * 50, "k int, v string")
    documents.write_json_array(df, f"{tmp_path}/d", ["k"], 4)
    assert json.loads(whole(f"{tmp_path}/d")) == [{"k": 1, "v": "x"}] * 50
